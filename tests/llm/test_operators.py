"""Every operator against its plain version, on small hostile tables and on the smallest driver tables."""

from __future__ import annotations

import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakebars.llm import (common, decontam, embed_dups, graph, lang_id, line_dedup, lm_score, mixing, quality, simhash,
                          substring_dedup, token_counts)
from tests.llm import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def vocabulary(n: int = 60, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 6))) for _ in range(n)]


def prose(rng: random.Random, n: int, words=None) -> str:
    words = words or vocabulary()
    return "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "\t", "\x0b"]) for _ in range(n))


def hostile() -> list[tuple]:
    """Ids with gaps and NULLs, NULL and empty texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(3)
    passage = prose(rng, 140)
    long = prose(rng, 6000, vocabulary(500, 5))
    texts = [None, "", " ", "\n\n", "A", "a", "É é", "!!", long, long + " x", "same " * 300, "same " * 290,
             "Case Matters Here", "case matters here", "case matters\there", "x y   z\x1cq"]
    texts += [prose(rng, rng.randint(1, 200)) for _ in range(25)]
    texts += [prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 40) for _ in range(6)]
    texts += ["A line that many share\n" + prose(rng, 20) + "\n  a LINE that many share \nshort\nshort" for _ in range(6)]
    ids = [7 * k % 101 for k in range(len(texts))]
    rows = list(zip(ids, texts))
    rows += [rows[9], rows[40], (rows[41][0], "other text of the same id " + passage), (None, passage), (None, None),
             (None, "A line that many share"), (None, "case matters here")]
    rows += [(200 + k, rows[8][1]) for k in range(5)] + [(300 + k, passage) for k in range(4)]
    return rows


def frame(spark, rows):
    """``documents`` with columns whose names clash with those the operators add or use."""
    full = [(i, t, ["en", None, "fr"][k % 3], ["src0", None, "https://h.org/a/b?c", "h.org/b"][k % 4],
             None if t is None else len(t), "x", None, k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS + ", n_words string, id string, rate long")


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def docs_of(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    return rows, [(r[0], r[1]) for r in rows.select("doc_id", "text").collect()]


@pytest.fixture(params=["hostile", pytest.param("tables", marks=data), "empty"])
def corpus(spark, request):
    if request.param == "tables":
        return docs_of(spark, SF)
    rows = hostile() if request.param == "hostile" else []
    return frame(spark, rows), rows


# ---------------------------------------------------------------- components

def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(500, 600)]
    pairs += [(900, k) for k in range(901, 960)] + [(None, 3), (4, 4)]
    found = {r["node"]: r["root"] for r in graph.connected_components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = sorted({x for p in pairs if None not in p for x in p})
    links = {p for p in pairs if None not in p}
    want = brute.components(nodes, lambda i, j: (nodes[i], nodes[j]) in links or (nodes[j], nodes[i]) in links)
    assert all(found.get(n, n) == want[k] for k, n in enumerate(nodes))


# ---------------------------------------------------------------- 1 near copies

def test_simhash(spark, corpus):
    docs, rows = corpus
    same(simhash.simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect(),
         brute.simhash_groups(rows))


@pytest.mark.parametrize("nodes", [4, 2048])
def test_simhash_links_of_large_buckets(spark, monkeypatch, nodes):
    """A cloud of fingerprints around few centres: chunks of a bucket lose no link."""
    monkeypatch.setattr(simhash, "BUCKET_NODES", nodes)
    rng = random.Random(4)
    fps = set()
    for centre in (0, (1 << 64) - 1, rng.getrandbits(64)):
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(50)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.close_edges(spark.createDataFrame([(f, k) for k, f in enumerate(signed)], "fp long, node long"))
    roots = {r["node"]: r["root"] for r in graph.connected_components(edges).collect()}
    want = brute.components(list(range(len(fps))), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    assert {k: roots.get(k, k) for k in want} == want


def test_simhash_long_text_in_pieces(monkeypatch):
    text = prose(random.Random(9), 900)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.fingerprint(text) == whole == np.uint64(brute.simhash(text)).view(np.int64)


def test_near_copies_keep_one_row_each(spark):
    rows = hostile()
    docs = frame(spark, rows)
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    firsts = sorted({c for i, _, c in brute.simhash_groups(rows) if i is not None})
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == firsts
    assert left.where("doc_id is null").count() == sum(i is None for i, _ in rows)


def test_near_copies_repeated_ids(spark):
    """A row of a repeated id is judged by its own text, and which of several stays is defined."""
    rng = random.Random(8)
    a, b, c, d = (prose(rng, 60, vocabulary(400, 9)) for _ in range(4))
    rows = [(3, a), *[(5, a)] * 4, (5, b), (7, c), (7, d)]
    kept = set()
    for part in (rows, rows[::-1]):
        docs = spark.createDataFrame(part, "doc_id long, text string").repartition(3)
        left = sorted(map(tuple, simhash.drop_near_copies(docs).collect()))
        assert left[:2] == [(3, a), (5, b)] and len(left) == 3 and left[2] in rows
        kept.add(left[2])
    assert len(kept) == 1


# ---------------------------------------------------------------- 2 embeddings

def vectors():
    rng = np.random.default_rng(8)
    rows, centres = [], rng.standard_normal((12, 24))
    for k in range(240):
        v = centres[k % 12] + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.2, 1.0])
        rows.append((3 * k % 1009, [float(x) for x in v * rng.choice([1.0, 7.5])]))
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23,
           [1.0] * 5, [2.0] * 5, [1.0], [-1.0], [3.0], [1e-200] * 24, [1e200] * 24, [-0.0] + [1.0] * 23, [0.0] + [1.0] * 23]
    rows += [(2000 + k, v) for k, v in enumerate(odd)]
    rows += [(3000 + k, rows[0][1]) for k in range(30)] + [(None, rows[0][1]), (None, None)]
    return rows


@pytest.mark.parametrize("nodes", [2048, 8])
def test_embedding_groups(spark, monkeypatch, nodes):
    """Wide caps find every link; counts are exact also when filters are split in chunks."""
    monkeypatch.setattr(embed_dups, "BUCKET_NODES", nodes)
    rows = vectors()
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                  "vec_id long, embedding array<double>, node long, n_links string")
    same(embed_dups.embedding_groups(table, cap=2.0, codewords=32, rotations=12).collect(), brute.cosine_groups(rows))


def test_embedding_groups_of_nothing(spark):
    assert embed_dups.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_recall_of_production_parameters():
    """Pairs at exactly the threshold, where filters find least."""
    rng = np.random.default_rng(1)
    a = rng.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)

    def recall(cosine):
        found = [{}, {}]
        for k, x in enumerate((a, cosine * a + math.sqrt(1 - cosine ** 2) * b)):
            for row, number in zip(*embed_dups.decode(x)):
                found[k].setdefault(int(row), set()).add(int(number))
        return np.mean([bool(found[0].get(i, set()) & found[1].get(i, set())) for i in range(len(a))])

    assert recall(0.9) >= 0.93 and recall(0.96) >= 0.98 and recall(0.99) >= 0.99


def close_pairs(n, dim, cosine, seed=1):
    rng = np.random.default_rng(seed)
    a = embed_dups.unit_rows(rng.standard_normal((n, dim)))
    b = rng.standard_normal(a.shape)
    b = embed_dups.unit_rows(b - (a * b).sum(axis=1, keepdims=True) * a)
    return a, cosine * a + math.sqrt(1 - cosine ** 2) * b


def shared_filters(x, y, **params):
    """Filters shared by the rows of two lists: row by row, and in all pairs of rows."""
    sides = [list(zip(*embed_dups.decode(v, **params))) for v in (x, y)]
    own = [{}, {}]
    for found, side in zip(own, sides):
        for row, number in side:
            found.setdefault(int(row), set()).add(int(number))
    counts = [np.unique([number for _, number in side], return_counts=True) for side in sides]
    both, i, j = np.intersect1d(counts[0][0], counts[1][0], return_indices=True)
    return [own[0].get(k, set()) & own[1].get(k, set()) for k in range(len(x))], int((counts[0][1][i] * counts[1][1][j]).sum())


@pytest.mark.parametrize("rows", [10_000, 50_000, 200_000, 2_000_000])
def test_embedding_work_for_each_vector_stays_the_same(rows):
    """At every size: recall 0.9 or more at the threshold, and unrelated vectors met by one vector within 30 %."""
    a, b = close_pairs(1200, 64, 0.9)
    shared, _ = shared_filters(a, b, rows=rows)
    assert np.mean([bool(s) for s in shared]) >= 0.9
    x, y = close_pairs(2500, 64, 0.0, seed=3)
    met = lambda n: shared_filters(x, y, rows=n)[1] / len(x) ** 2 * n
    assert 0.5 * met(10_000) < met(rows) < 1.3 * met(10_000)


def test_embedding_caps():
    for dim in (3, 4, 16, 64):
        v = embed_dups.unit_rows(np.random.default_rng(2).standard_normal((200_000, dim)))[:, 0]
        for least in (0.0, 0.2, 0.5):
            assert abs(embed_dups.cap_share(dim, least) - (v > least).mean()) < 0.01
    assert embed_dups.scaled(10, 64) == (128, 0.4) and embed_dups.scaled(10**6, 2)[0] == 128
    for dim in (3, 4, 16, 64, 1024):
        few, many = embed_dups.scaled(20_000, dim), embed_dups.scaled(10**9, dim)
        assert 128 <= few[0] < many[0] and few[1] <= many[1] < 1


# ---------------------------------------------------------------- 3 lines

@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup(spark, corpus, batches):
    docs, rows = corpus
    got = line_dedup.dedup_lines(docs, batches=batches, n_lines="lines", n_dropped="dropped")
    assert got.columns == [*docs.columns, "lines", "dropped"]
    same(got.select("doc_id", "lines", "dropped", F.coalesce("text", F.lit(""))).collect(), brute.line_dedup(rows))
    assert got.where("text is null").count() == sum(t is None for _, t in rows)


def test_line_index_compacts(spark):
    index = line_dedup.LineIndex(spark, fanout=2)
    rows = [(k, f"line number {k % 9} of them\nits own line {k:04d}") for k in range(40)]
    for lo in range(0, 40, 8):
        lines = line_dedup.keyed_lines(spark.createDataFrame(rows[lo:lo + 8], "doc_id long, text string"),
                                       "doc_id", "text", 10)
        repeats = {(r["id"], r["pos"]) for r in index.add(lines).collect()}
        assert repeats == {(k, 0) for k in range(max(lo, 9), lo + 8)}
    assert [len(x) for x in index.levels] == [1, 0, 1]
    assert index.known().count() == 9 + 40 == index.known().distinct().count()


# ---------------------------------------------------------------- 4 tokens

@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_token_counts(spark, corpus, tokenizer_path):
    from tokenizers import Tokenizer

    docs, rows = corpus
    extra = [(900, "a <|endoftext|> b<|startoftext|>c don't é ́ ΑΣ ΑΣ. İ 3rd 12345 x y　z\x1cq\x85r \U0001F600"),
             (901, "word" * 3000)] if "id" in docs.columns and rows else []
    if extra:
        docs, rows = frame(spark, rows + extra), rows + extra
    library = Tokenizer.from_file(tokenizer_path)
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    same(token_counts.token_counts(docs, tokenizer_path, frequent=50, cache=40).collect(),
         [(i, len((t or "").encode()), k, k > 2048) for (i, t), k in zip(rows, n)])


def test_unsuitable_tokenizers_are_refused(spark, tmp_path):
    """One that keeps white space as tokens, one that joins words: counts of pieces would be wrong."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    for name, split in (("whole", None), ("spaces", pre_tokenizers.Split(" ", "isolated"))):
        tokenizer = Tokenizer(models.WordLevel({"[u]": 0, " ": 1, "a": 2}, unk_token="[u]"))
        if split is not None:
            tokenizer.pre_tokenizer = split
        path = str(tmp_path / f"{name}.json")
        tokenizer.save(path)
        with pytest.raises(ValueError, match="white space"):
            token_counts.token_counts(frame(spark, hostile()[:12]), path)


def test_long_pieces_are_not_remembered(tokenizer_path):
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = token_counts.load(f.read())
    lengths = token_counts.Lengths({}, tokenizer, 10)
    long = b"abc" * 5000
    assert lengths[long] == token_counts.count(tokenizer, long) and not lengths
    for k in range(30):
        assert lengths[f"w{k}".encode()] == token_counts.count(tokenizer, f"w{k}".encode())
    assert len(lengths) <= 10


def test_languages_are_bounded(spark, monkeypatch):
    rows = [(k, f"word{k % 30} text", f"l{k % 30}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(lang_id, "ALL_SAMPLES", 60)
    model = lang_id.fit(docs, "text", "lang", id_col="doc_id")
    assert len(model["langs"]) == 30
    monkeypatch.setattr(lang_id, "LANGUAGES", 29)
    with pytest.raises(ValueError, match="29 languages"):
        lang_id.fit(docs, "text", "lang")


def test_token_slices(monkeypatch):
    data_ = prose(random.Random(1), 400).encode()
    whole = data_.split()
    monkeypatch.setattr(token_counts, "SLICE", 11)
    assert [w for part in token_counts.slices(data_) for w in part] == whole


# ---------------------------------------------------------------- 5 quality

def judged(n=700, seed=6):
    rng = random.Random(seed)
    words = vocabulary(300, 2)
    docs, labels = [], []
    for k in range(n):
        text, low_, toxic = prose(rng, rng.randint(8, 120), words), 0, 0
        if k % 10 == 1:
            low_, text = 1, " ".join([rng.choice(words)] * 60) if k % 20 == 1 else text.upper() + " %%% *** $$$" * 6
        if k % 10 == 2:
            toxic, text = 1, text + " " + rng.choice(["vilest", "zogga", "zoggb", "zoggc"]) + " " + prose(rng, 30, words)
        docs.append((k, text))
        if k % 2 or k % 10 == 2:
            labels.append((k, 1 - low_, toxic))
    return docs, labels


def test_quality_catches_planted(spark):
    docs, labels = judged()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.assess(frame(spark, docs), table).collect()}
    bad = {k for k, _ in docs if k % 10 in (1, 2)}
    missed, lost = {k for k in bad if got[k]["kept"]}, {k for k in got if k not in bad and not got[k]["kept"]}
    assert len(missed) <= 0.05 * len(bad) and len(lost) <= 0.01 * len(docs)
    left = quality.keep_good(frame(spark, docs), table)
    assert left.columns == frame(spark, docs).columns
    assert {r["doc_id"] for r in left.collect()} == {k for k in got if got[k]["kept"]}


def test_quality_hostile(spark):
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (14, None, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = hostile()
    assert quality.assess(frame(spark, rows), labels).count() == len(rows)
    assert quality.assess(frame(spark, rows), labels.limit(0)).where("kept").count() == len(rows)
    assert quality.assess(frame(spark, []), labels).count() == 0
    assert quality.keep_good(frame(spark, []), labels).count() == 0


def test_quality_learns_from_half_labels(spark):
    """A label whose other half is NULL teaches its own classifier."""
    docs, labels = judged()
    halves = [(k, q, None) for k, q, _ in labels] + [(k, None, t) for k, _, t in labels]
    schema = "doc_id long, quality int, toxic int"
    docs = frame(spark, docs)
    whole = quality.fit(docs, spark.createDataFrame(labels, schema))
    apart = [(k, q if k % 2 else None, t if k % 10 in (2, 5) else None) for k, q, t in labels]
    assert set(quality.fit(docs, spark.createDataFrame(apart, schema))["models"]) == {"low", "toxic"}
    split = quality.fit(docs, spark.createDataFrame(halves, schema))
    assert split["features"] == whole["features"] and set(split["models"]) == {"low", "toxic"}


def test_quality_sites_shrink(spark):
    """A host of one document follows the global share; a large one its own; paths follow their hosts."""
    scored = ([("a.org/x", 0.9)] * 400 + [("a.org/y", 0.9)] * 2 + [("b.org", 0.1)] * 400 + [("c.org", 0.9)]
              + [("d%d.org" % k, 0.3 + 0.4 * (k % 2)) for k in range(40)])
    table = spark.createDataFrame([(k, s, p) for k, (s, p) in enumerate(scored)], "id long, source string, bad double")
    sites, overall = quality.site_posteriors(table, "source", "bad")
    names = {"host_prior": "h", "path_prior": "p", "posterior": "z"}
    got = {r["source"]: r for r in quality.judge(table, sites, overall, names, "source", "bad").collect()}
    assert abs(got["c.org"]["h"] - overall) < 1e-6       # its only document's own part is taken out
    assert got["a.org/x"]["h"] > 0.85 and got["b.org"]["h"] < 0.15
    assert abs(got["a.org/y"]["p"] - got["a.org/y"]["h"]) < 0.05


@pytest.mark.parametrize("source, host, path", [
    ("https://h.org/a/b?c=1", "h.org", "h.org/a"), ("h.org", "h.org", "h.org"), (None, "", ""), ("h.org?x", "h.org?x", "h.org"),
    ("ftp://h/", "h", "h/")])
def test_quality_host_and_path(spark, source, host, path):
    row = spark.createDataFrame([(source,)], "s string").select(quality.host_of(F.col("s")), quality.path_of(F.col("s")))
    assert tuple(row.first()) == (host, path)


# ---------------------------------------------------------------- 6 language model

def test_lm_scores(spark, corpus):
    docs, rows = corpus
    got = lm_score.score_documents(docs).select("doc_id", "n_words", "n_seen", F.round("log_score", 6)).collect()
    want = [(i, n, s, round(x, 6) + 0.0) for i, n, s, x in brute.lm_scores(rows)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-4)


@pytest.mark.parametrize("order, group_bytes", [(2, 200), (3, 1 << 24), (4, 200)])
def test_lm_orders(spark, monkeypatch, order, group_bytes):
    """Longer contexts, and more groups than shuffle partitions where the text is large."""
    monkeypatch.setattr(lm_score, "GROUP_BYTES", group_bytes)
    rows = hostile()
    docs = frame(spark, rows)
    size = sum(len((t or "").encode()) for _, t in rows)
    groups, ranges = lm_score.groups_and_ranges(docs)
    assert groups == max(8, -(-size // group_bytes)) and ranges == max(4, groups // 2)
    if group_bytes < size:   # so many groups only for a part of the rows
        rows = rows[::3]
        docs = frame(spark, rows)
    got = lm_score.score_documents(docs, order=order).select("doc_id", "n_words", "n_seen", "log_score").collect()
    want = brute.lm_scores_of_order(rows, order)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], round(r[3], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-4)


def test_lm_packing():
    rng = np.random.default_rng(0)
    numbers = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    assert (lm_score.unpack(lm_score.pack(numbers), 1000) == numbers).all()
    cuts = lm_score._cuts(numbers, 7)
    assert cuts[0] == 0 and cuts[-1] == 1000 and (np.diff(cuts) >= 0).all()
    assert (numbers[cuts[3]:cuts[4]] >> np.uint64(32) < (4 * (1 << 32) // 7) + 1).all()


# ---------------------------------------------------------------- 7 mixing

def test_mixing_reaches_targets(spark):
    rng = random.Random(5)
    words = {d: vocabulary(80, s) for d, s in (("en", 11), ("fr", 12), ("de", 13))}
    rows = []
    for k in range(600):
        d = "en" if k % 6 < 4 else ("fr", "de")[k % 2]
        rows.append((k, prose(rng, rng.randint(1, 150), words[d]), d if k % 3 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    targets = {"en": 1, "fr": 2, "de": 1}
    out = mixing.mix(docs, docs, targets, keep=["doc_id"]).collect()
    assert len(out) == len(rows) and all(r["rate"] >= 0 for r in out)
    assert {r["doc_id"]: r["n_words"] for r in out} == {i: len(brute.spaced(t)) for i, t, _ in rows}
    before = sum(r["n_words"] for r in out)
    total = np.array([np.array(r["posteriors"]) * r["n_words"] * r["rate"] for r in out]).sum(axis=0)
    assert np.allclose(total / before, [0.25, 0.25, 0.5], atol=1e-4)     # de, en, fr
    truth = {i: "en" if i % 6 < 4 else ("fr", "de")[i % 2] for i, _, _ in rows}
    assert np.mean([r["domain"] == truth[r["doc_id"]] for r in out]) > 0.97


@pytest.mark.parametrize("spread", [0.1, 0.6, 0.9])
def test_mixing_soft_memberships(spark, spread):
    """Overlapping domains reach their targets to the promised tolerance too."""
    rng = np.random.default_rng(4)
    domain = rng.choice(4, 400, p=[.6, .15, .15, .1])
    p = (1 - spread) * np.eye(4)[domain] + spread / 4
    rows = [(k, int(n), 1, *map(float, x)) for k, (n, x) in enumerate(zip(rng.integers(0, 300, 400), p))]
    members = spark.createDataFrame(rows, "id long, n long, rows long, p0 double, p1 double, p2 double, p3 double")
    share = (p * np.array([r[1] for r in rows])[:, None]).sum(axis=0)
    for weights in (None, [0.25] * 4, (0.5 * share[::-1] / share.sum() + 0.125).tolist() if spread < 0.5 else None):
        rated, fit = mixing.fit_rates(members, 4, weights)
        got = np.array([[r["rate"] * r["n"] * r[f"p{i}"] for i in range(4)] for r in rated.collect()])
        assert rated.where("rate < 0").count() == 0
        assert np.abs(got.sum(axis=0) - fit["targets"]).max() <= 2e-6 * share.sum() and fit["gap"] <= mixing.TOLERANCE


def test_mixing_reports_what_cannot_be_reached(spark):
    rows = [(k, 10, 1, 0.5, 0.5) for k in range(20)]
    members = spark.createDataFrame(rows, "id long, n long, rows long, p0 double, p1 double")
    rated, fit = mixing.fit_rates(members, 2, [0.9, 0.1])
    assert abs(fit["gap"] - 0.4) < 1e-6 and rated.where("abs(rate - 1) > 1e-4").count() == 0


def test_mixing_hostile(spark):
    rows = hostile()
    docs = frame(spark, rows)
    out = mixing.mix(docs, docs)
    assert out.columns[:len(docs.columns)] == docs.columns and out.count() == len(rows)
    assert out.where("_rate is null or _rate < 0 or isnan(_rate)").count() == 0
    words = {(r["doc_id"], r["text"]): r["_n_words"] for r in out.collect()}
    assert words == {(i, t): len(brute.spaced(t)) for i, t in rows}
    assert mixing.mix(frame(spark, []), docs).count() == 0
    none = mixing.mix(docs, docs.limit(0), keep=["doc_id"])
    assert none.where("rate = 1.0 and domain is null").count() == len(rows)
    one = mixing.mix(docs, docs.where("lang = 'en'"), keep=["doc_id"])
    assert one.where("abs(rate - 1) < 1e-9 and domain = 'en'").count() == len(rows)


# ---------------------------------------------------------------- 8 decontamination

def items_for(rows):
    texts = [t for _, t in rows if t and len(t.split()) > 60][:4]
    items = [(k, " ".join(t.split()[5 * k:5 * k + 20 + k])) for k, t in enumerate(texts)]
    items += [(k + 20, " ".join(t.split()[:13]).upper()) for k, t in enumerate(texts)]
    return items + [(90, None), (91, ""), (92, "!!"), (93, "same " * 40), (94, "same same"), (95, "A"), (20, "x y z"),
                    (None, " ".join(["same"] * 13)), (96, "case MATTERS here"), (97, "word that nobody has ever used")]


@pytest.mark.parametrize("block_bytes, shard", [(1 << 20, 1 << 20), (300, 50)])
def test_contamination(spark, corpus, monkeypatch, block_bytes, shard):
    monkeypatch.setattr(decontam, "SHARD_WORDS", shard)
    docs, rows = corpus
    items = items_for(rows)
    if "id" not in docs.columns:
        items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, n_hit long")
    names = {"n_words": "own_words"}
    got = decontam.contamination(docs, bench, block_bytes=block_bytes, keep=["doc_id"], names=names)
    same([(r[0], r["own_words"], r["n_hit"], sorted(r["items"] or []), r["contaminated"]) for r in got.collect()]
         if rows else [], brute.contamination(rows, items))
    left = decontam.decontaminate(docs, bench, block_bytes=block_bytes)
    assert left.columns == docs.columns
    assert left.count() == sum(not r[4] for r in brute.contamination(rows, items))


def test_contamination_longest_matches(spark):
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(1, " ".join(["a", "b", *words[10:45], "c"])), (2, " ".join(words[:12]))],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(words)), (6, " ".join(words[20:40]))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontam.contamination(docs, bench).collect()}
    assert [tuple(m) for m in got[1]["matches"]] == [("5", 10, 2, 35), ("6", 0, 12, 20)]
    assert [tuple(h) for h in got[1]["hits"]] == [(2, 37)] and not got[2]["matches"]


@pytest.mark.parametrize("pairs", [1 << 20, 3])
def test_contamination_repeated_windows(spark, monkeypatch, pairs):
    """An item that repeats a window: the longest match may begin at any of its places."""
    monkeypatch.setattr(decontam, "PAIRS", pairs)
    head, a, b = ([f"{x}{k}" for k in range(n)] for x, n in (("t", 13), ("a", 40), ("b", 200)))
    items = {"1": [*head, *a, *head, *b], "2": ["same"] * 40, "3": [*a[:3], *head, *a, *b[:20], *head, *a[:30]]}
    docs = {1: ["x", "y", *head, *b, "z"], 2: ["same"] * 30, 3: ["x", *["same"] * 60],
            4: [*head, *a, "x", *a[1:], *head, *b[:9]], 5: [*a, *b, *head, *a], 6: ["z", *head, "z", *head]}
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id string, text string")
    got = decontam.contamination(rows, bench, keep=["doc_id"]).collect()

    def longest(doc, item):
        best = (0, 0, 0)
        for at in range(len(doc)):
            for start in range(len(item)):
                n = 0
                while at + n < len(doc) and start + n < len(item) and doc[at + n] == item[start + n]:
                    n += 1
                best = max(best, (n, -at, -start))
        return best

    for r in got:
        want = {i: longest(docs[r["doc_id"]], w) for i, w in items.items()}
        assert {tuple(m) for m in r["matches"]} == {(i, -s, -at, n) for i, (n, at, s) in want.items() if n >= 13}
    assert ("1", 53, 2, 213) in {tuple(m) for r in got for m in r["matches"]}


def test_contamination_blocks_stay_out_of_the_driver(spark, monkeypatch):
    """Many blocks of repeated templates: nothing is broadcast or collected but a size, and one block gives the same."""
    from pyspark import SparkContext

    words = vocabulary(80, 4)
    rng = random.Random(6)
    items = [(f"i{k}", "the same template " + " ".join(rng.choice(words) for _ in range(30))) for k in range(200)]
    items += items[:60] * 3                                     # repeated rows
    docs = frame(spark, [(k, f"x {items[k * 7 % 200][1]} y {items[k][1]}") for k in range(40)] + [(99, "clean")])
    bench = spark.createDataFrame(items, "item_id string, text string")

    def shown(**params):
        out = decontam.contamination(docs, bench, keep=["doc_id"], names={"n_words": "w"}, **params)
        return sorted((r["doc_id"], r["w"], r["n_hit"], r["items"], sorted(map(str, r["matches"])), r["contaminated"])
                      for r in out.collect())

    want = shown()
    monkeypatch.setattr(SparkContext, "broadcast", lambda *a: pytest.fail("broadcast"))
    assert shown(block_bytes=1500) == want and sum(r[2] > 0 for r in want) == 40
    _, blocks = decontam.write_blocks(bench, "item_id", "text", 1500, 13)
    assert blocks > 10


def test_contamination_without_items(spark):
    docs = frame(spark, hostile())
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs, bench).count() == docs.count()


# ---------------------------------------------------------------- 9 language

def test_language_id(spark):
    rng = random.Random(7)
    words = {d: vocabulary(120, s) for d, s in (("en", 21), ("fr", 22), ("de", 23))}
    rows = [(k, prose(rng, rng.randint(4, 80), words[d]), d) for k in range(500) for d in [("en", "fr", "de")[k % 3]]]
    extra = [(900, None, "en"), (901, "", "fr"), (902, "123 !?  ", "en"), (903, "É", None), (None, "hello", None)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")
    out = lang_id.identify(docs).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) + len(extra)
    assert all(r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {900, 901, 902}
    assert all(0 <= r["score"] <= 1 for r in out)
    held = [(got[i]["lang_pred"] == d) for i, _, d in rows if got[i]["held_out"]]
    assert len(held) > 80 and np.mean(held) > 0.97


def test_language_id_does_not_see_held_out(spark):
    rows = [(k, f"word{'abc'[k % 3]} text", "xx" if zlib.crc32(str(k).encode()) % 4 == 2 else "ab"[k % 2])
            for k in range(60)]
    out = lang_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in out.collect()} <= {"a", "b"}


def test_sample_of_copies_is_bounded(spark, monkeypatch):
    """Copies of a text are drawn one by one, and never more than the sample."""
    rows = [(k, "one text that many rows have" if k % 3 == 0 else f"text {k}", "ab"[k % 2]) for k in range(3000)]
    rows += [(-1, "a row that comes often", "a")] * 900 + [(None, "no id", "b")] * 900
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    chosen = common.draw(docs, "lang", ["doc_id", "text"], 300, 7).collect()
    for lang in "ab":
        own = [r for r in chosen if r["lang"] == lang]
        copies = sum(r["doc_id"] is not None and r["doc_id"] >= 0 and r["doc_id"] % 3 == 0 for r in own)
        assert len(own) == 300 == len({(r["doc_id"], r["text"]) for r in own}) and 60 < copies < 140
    got = []
    train = lang_id.train
    monkeypatch.setattr(lang_id, "train", lambda rows, *a: got.append(len(rows)) or train(rows, *a))
    lang_id.fit(docs, "text", "lang", sample=50, id_col="doc_id")
    assert 0 < got[0] <= 100
    assert common.draw(docs.limit(0), "lang", ["doc_id"], 5, 7).count() == 0


def test_language_id_hostile(spark):
    rows = hostile()
    assert lang_id.identify(frame(spark, rows)).count() == len(rows)
    assert lang_id.identify(frame(spark, [])).count() == 0
    nothing = lang_id.identify(frame(spark, rows).withColumn("lang", F.lit(None).cast("string")))
    assert nothing.where("lang_pred = 'und' and score = 0").count() == len(rows)


def test_language_features_in_slices(monkeypatch):
    text = prose(random.Random(2), 300)
    whole = lang_id.features(text)
    monkeypatch.setattr(lang_id, "SLICE", 13)
    assert np.allclose(lang_id.features(text), whole)


# ---------------------------------------------------------------- 10 repeated substrings

def test_substrings(spark, corpus):
    docs, rows = corpus
    got = substring_dedup.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    same(got.collect(), brute.substrings(rows))


def test_substring_levels(spark):
    rng = random.Random(12)
    shared = prose(rng, 420, vocabulary(900, 3))
    rows = [(k, prose(rng, 30, vocabulary(900, 4)) + " ".join(shared.split()[:n]) + " " + prose(rng, 9))
            for k, n in enumerate((55, 120, 230, 420, 420, 3))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    full = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(table).collect()}
    assert {i: r["longest_repeat"] for i, r in full.items() if r["longest_repeat"]} == brute.longest_level(rows)
    short = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_substrings(table, max_words=50).collect()}
    assert short == {i: r["n_removed"] for i, r in full.items()}


@pytest.mark.parametrize("length", [1, 2, 3, 25, 50, 64, 100])
def test_window_hashes(length):
    rng = np.random.default_rng(length)
    words = rng.integers(0, 5, 400).astype(np.uint64)
    h = substring_dedup.window_hashes(words, length)
    assert len(h) == 400 - length + 1
    grams = [tuple(words[k:k + length]) for k in range(len(h))]
    assert len(set(zip(grams, h.tolist()))) == len(set(grams)) == len(set(h.tolist()))


def test_least_of():
    h = np.random.default_rng(3).integers(0, 1 << 60, 90).astype(np.uint64)
    for width in (1, 2, 3, 26, 90):
        want = [h[k:k + width].min() for k in range(91 - width)]
        assert substring_dedup.least_of(h, width).tolist() == want


def test_first_shared():
    rng = np.random.default_rng(8)
    own = [np.sort(rng.choice(60, rng.integers(0, 40), replace=False)) for _ in range(50)]
    i, j = np.nonzero(np.triu(np.ones((50, 50)), 1))
    for number in (0, 7, 30, 60):
        want = [not (set(own[a]) & set(own[b]) & set(range(number))) for a, b in zip(i, j)]
        assert embed_dups.first_shared(own, i, j, number).tolist() == want
    assert embed_dups.first_shared([np.zeros(0, int)] * 2, np.array([0]), np.array([1]), 5).tolist() == [True]
