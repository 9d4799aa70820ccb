"""The corpus pipeline, stage by stage against the plain versions, and its edge cases."""

from __future__ import annotations

import os
import random
import subprocess
import sys

import pytest

import corpus_pipeline as P
from lakebars.llm.common import materialize, new_run_dir
from tests.llm import brute
from tests.llm.test_operators import DOCS, hostile, items_for, judged, prose

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write_tables(spark, docs, labels, items) -> str:
    root = new_run_dir(spark, "pipeline-tables")
    rows = [(i, t, ("en", None, "fr")[k % 3], f"src{k % 4}", None if t is None else len(t))
            for k, (i, t) in enumerate(docs)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def stages_match(spark, sf_dir):
    """Runs the stages one by one; returns what the first and the last one gave."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    outputs = {}
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    order = lambda rows: sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
    for name, stage in P.STAGES:
        before = pairs(docs)
        out = materialize(stage(spark, docs, sf_dir), name)
        after = pairs(out)
        if name == "line_dedup":
            nulls = {i for i, t in before if t is None}
            want = [(i, None if i in nulls and not t else t) for i, _, _, t in brute.line_dedup(before)]
            assert order([(i, t or "") for i, t in after]) == order([(i, t or "") for i, t in want])
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())
        if name == "near_copies":
            first = {c for i, _, c in brute.simhash_groups(before) if i is not None}
            assert sorted(i for i, _ in after if i is not None) == sorted(first)
        if name == "decontamination":
            assert order([i for i, _ in after] and [(i,) for i, _ in after]) == order(
                [(r[0],) for r in brute.contamination(before, items) if not r[4]])
        if name != "mixing":
            assert out.columns == COLUMNS
        assert set(after) <= set(before) or name == "line_dedup"
        outputs[name] = after
        docs = out
    assert out.columns[:5] == COLUMNS and out.where("rate is null or rate <= 0").count() == 0
    return outputs


@pytest.mark.parametrize("kind", ["planted", "hostile"])
def test_stages(spark, kind):
    rng = random.Random(1)
    if kind == "hostile":
        docs, labels = hostile(), [(7, 1, 0), (14, 1, 1), (None, 0, 1)]
    else:
        docs, labels = judged(400)
        docs += [(1000 + k, docs[5][1]) for k in range(30)]                       # copies of a clean document
        docs += [(2000, prose(rng, 5) + " ".join(docs[9][1].split()[:40]))]
    items = items_for(docs)
    out = stages_match(spark, write_tables(spark, docs, labels, items))
    if kind == "planted":
        kept = {i for i, _ in out["quality"]}
        bad = {k for k, _ in docs if k < 400 and k % 10 in (1, 2)}
        assert len(kept & bad) <= 0.05 * len(bad) and len(kept) >= 0.98 * (len(docs) - len(bad))
        # line dedup leaves the copies their short lines only, the same for all: one of them stays
        assert len({i for i, _ in out["near_copies"]} & set(range(1000, 1030))) <= 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_run_on_tables(spark):
    out = P.run(spark, SF)
    staged = stages_match(spark, SF)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, _ in staged["mixing"])


def test_empty_tables(spark):
    root = write_tables(spark, [], [], [])
    assert P.run(spark, root).count() == 0


def test_entry_lists_queries_without_a_session():
    code = "import __spark_entry__ as e; print(len([n for n in e.queries() if n.startswith('op')]), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["13", "True"], out.stderr[-800:]


def test_run_leaves_its_result_only(spark, monkeypatch):
    """Side tables of the operators and of earlier stages are gone, after an error all of them."""
    from lakebars.session import work_root

    docs, labels = judged(120)
    root = write_tables(spark, docs, labels, [(1, prose(random.Random(1), 40))])
    top = work_root(spark)
    folders = lambda: {d for d in os.listdir(top) if d != "_side"} | {f"_side/{d}" for d in os.listdir(f"{top}/_side")}
    before = folders()
    out = P.run(spark, root)
    (left,) = folders() - before
    assert left.startswith("_side/pipeline-mixing") and out.count() > 0
    monkeypatch.setattr(P, "STAGES", [*P.STAGES[:2], ("broken", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))])
    before = folders()
    with pytest.raises(RuntimeError, match="lost"):
        P.run(spark, root)
    assert {d.split("-")[1] for d in folders() - before} <= {"line_dedup"}
