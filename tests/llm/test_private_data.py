"""Operator 13 against a plain version: the patterns as they are written down, all words of all texts in one list."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest

from lakebars.llm import private_data, queries
from tests.llm.test_operators import SF, data, docs_of, frame, hostile, same

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    number = lambda s: re.sub("[^0-9]", "", s)

    def luhn(digits):
        total = 0
        for k, d in enumerate(reversed(digits)):
            d = int(d) * (1 + k % 2)
            total += d // 10 + d % 10
        return total % 10 == 0

    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(number(m.group())) <= 19 and luhn(number(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(number(m.group())) <= 15]
    return sorted(out)


def plain(texts, window=8, support=3, least=0.95):
    """``[(base, spans, generalisations)]`` of each text."""
    near, together, shown, often, total = Counter(), Counter(), defaultdict(set), Counter(), 0
    parsed = []
    for text in texts:
        text = text or ""
        base = plain_base(text)
        covered = set().union(*[range(a, b) for a, _, b in base]) if base else set()
        clear = "".join(" " if i in covered else c for i, c in enumerate(text))
        words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\w+", clear)]
        parsed.append((base, words))
        names = [w for _, _, w in words]
        often.update(names)
        often.update(w[:2] + "*" for w in names)
        total += len(words)
        counted = defaultdict(set)
        for a, kind, b in base:
            who = (kind, text[a:b].lower() if kind == 0 else text[a:b] if kind == 1 else re.sub("[^0-9]", "", text[a:b]))
            after = sum(x[1] <= a for x in words)
            later = sum(x[0] < b for x in words)
            around = [*range(max(0, after - window), after), *range(later, min(len(words), later + window))]
            new = [k for k in around if k not in counted[who]]
            counted[who].update(around)
            context = (len(new), *[names[k] for k in around])
            near[who] += len(new)
            for k in new:
                for name in (names[k], names[k][:2] + "*"):
                    together[who, name] += 1
            for w in {names[k] for k in new}:
                shown[who, w].add((context, tuple(sorted(Counter(names[k] for k in new).items()))))
    broad = defaultdict(int)          # contexts of a generalisation: one for each different term of each context
    for (who, w), seen in shown.items():
        broad[who, w[:2] + "*"] += len(seen)
    counts = {**{k: len(v) for k, v in shown.items()}, **broad}

    def told(who, name):
        if counts.get((who, name), 0) < support or near[who] >= total:
            return None
        share = 1 - math.log2(often[name] / together[who, name]) / math.log2(total / near[who])
        return share if share >= least else None

    terms = {}
    for who, w in shown:
        if told(who, w) is not None:
            terms[w] = terms.get(w, False) or told(who, w[:2] + "*") is not None
    out = []
    for base, words in parsed:
        added = [(a, 4, b) for a, b, w in words if w in terms]
        out.append((base, sorted(base + added), {(a, b): "" if terms[w] else w[:2] + "*" for a, b, w in words if w in terms}))
    return out


def spell(spans):
    return ",".join(f"{private_data.LABELS[k]}:{a}:{b}" for a, k, b in spans)


def personal(seed=5):
    """Texts in which some terms stand by one entity only, some everywhere, and odd spellings of every kind."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 6))) for _ in range(150)]
    words += ["the", "The", "and", "from", "office", "call"] * 20
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for k in range(60):
        rows.append(some(rng.randint(0, 60)))
        if k % 4 == 0:
            rows[-1] += f" Zebulon {some(2)} wrote from zeb@Mail.example.com, the Quartzmine office. {some(5)}"
        if k % 4 == 1:
            rows[-1] += f" call {some(1)} +1 (555) 123-4567, Quorra {some(3)}; {some(9)} +1 (555) 123-4567"
        if k % 4 == 2:
            rows[-1] += f" quokka 10.0.0.{k} and card 4111 1111 1111 1111 {some(4)}"
    rows += ["the quokka and the Quartzite", "Zebulon alone, zebulon again", "Zebra zebu zeal zest zero"]
    rows += ["a@b.c", "a@b", "@x.y", "x@@y.z", "a.b@c.d.e@f.g", "x@y.z.", "p_q@r.s", "..@..a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255",
             "01.002.0003.4", "1.2.3", "+12345", "+1234567890", "+1 2-3(4)5.6 7890", "+1234567890123456", "++1234567890 ", "4111-1111-1111-1111",
             "4111 1111 1111 1112", "4111  1111 1111 1111", "00000000000000", "9" * 60, "+" * 40 + "1" * 12, "a@b.c," * 30, "é@é.fr x@é.fr z@a.fré",
             "١٢٣.1.1.1", "+1 555 123 4567 x@y.zz 1.1.1.1 4111111111111111", "İstanbul a@b.cc İSTANBUL ß"]
    rows += [rows[0]] * 3 + [rows[2]] * 50                          # copies show one context
    return list(enumerate(rows))


@pytest.fixture(params=["personal", "hostile", pytest.param("tables", marks=data), "empty"])
def texts(spark, request):
    if request.param == "tables":
        return docs_of(spark, SF)
    rows = {"personal": personal, "hostile": hostile, "empty": list}[request.param]()
    return frame(spark, rows), rows


def test_private_spans(spark, texts, monkeypatch):
    docs, rows = texts
    want = [(i, *[sum(k == kind for _, k, _ in base) for kind in range(4)], hashlib.sha256(spell(base).encode()).hexdigest(), spell(spans))
            for (i, _), (base, spans, _) in zip(rows, plain([t for _, t in rows]))]
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    same([tuple(r) for r in queries.op13_pii(spark, "").collect()], want)


def test_terms_disclose(spark):
    """Terms that only one entity has are found wherever they stand; frequent ones and single contexts are left alone."""
    rows = personal()
    found = {r["doc_id"]: r for r in private_data.private_spans(frame(spark, rows)).collect()}
    terms = Counter(rows[i][1][s["start"]:s["end"]].lower() for i, r in found.items() for s in r["spans"] if s["kind"] == 4)
    assert {"zebulon", "quartzmine"} <= set(terms) and "the" not in terms
    alone = next(i for i, t in rows if t.startswith("Zebulon alone"))
    assert [(s["start"], s["end"]) for s in found[alone]["spans"]] == [(0, 7), (15, 22)]


def test_sanitise(spark):
    rows = personal() + [(1000, None), (None, "")]
    told = plain([t for _, t in rows])
    out = private_data.sanitise(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns

    def cleaned(text, spans, terms):
        for a, k, b in reversed(spans):                             # from the end, so that places stay
            text = text[:a] + (terms[a, b] if k == 4 else f"[{private_data.LABELS[k].upper()}]") + text[b:]
        return text

    want = [(i, None if t is None else cleaned(t, spans, terms)) for (i, t), (_, spans, terms) in zip(rows, told)
            if all(x[2] <= y[0] for x, y in zip(spans, spans[1:]))]
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert sum(got.values()) == len(rows)
    for row in want:
        assert got[row] > 0, row
    assert any("[EMAIL]" in (t or "") and "Zebulon" not in t for _, t in got)


def test_patterns_in_linear_time():
    """Long runs without a match: seconds if the patterns started anew at every place."""
    for text in ("a" * 300_000, "a@" * 100_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "+1" + " " * 300_000, "x" * 300_000 + "@" + "y" * 300_000):
        private_data.base_spans(text)
    for text in ("a" * 2000, "a@" * 500, "1" * 2000, "1." * 700, "+1 " * 300, "x" * 500 + "@" + "y" * 500 + ".z", "12-3 " * 99):
        assert private_data.base_spans(text) == plain_base(text)


def test_random_patterns():
    rng = random.Random(11)
    for _ in range(3000):
        text = "".join(rng.choice("a1.@+- (0)_é9") for _ in range(rng.randint(0, 60)))
        assert private_data.base_spans(text) == plain_base(text), text


def test_words_before():
    text = "one two  three four-five " + "x" * 500 + " six"
    places = [(m.start(), m.end()) for m in re.finditer(r"\w+", text)]
    for at in range(len(text) + 1):
        for n in (1, 2, 8):
            ends = [(a, b) for a, b in places if b <= at]
            inside = [(a, at) for a, b in places if a < at < b]
            assert private_data.words_before(text, at, n) == (ends + inside)[-n:]
