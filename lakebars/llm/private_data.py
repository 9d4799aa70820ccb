"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: e-mail addresses, IP addresses, card
and phone numbers.  What a term tells about an entity is estimated from how
often they stand together in the corpus.  The probability space are the word
positions of all texts, protected spans left out; ``p(e)`` is the share of
positions within ``WINDOW`` words of entity e, ``p(t)`` that of term t.  With
the information of an entity, ``IC(e) = -log2 p(e)``, and the point-wise
mutual information of the two, a term discloses the share

    PMI(e; t) / IC(e) = 1 - log2(1 / p(e | t)) / IC(e)

of the entity.  A term that reaches ``DISCLOSURE`` for any entity, in
``SUPPORT`` or more different contexts (copies of a context count once), is
generalised to its first two letters if those disclose less than that, and
removed otherwise, wherever it stands.

Texts are read three times and shuffled never: for entities and contexts,
for the frequencies of the terms of contexts, for the places of disclosing
terms.  Which words a pass reports is decided by a bitmap of word hashes of
fixed size (``BITS``), built by Spark; a word that shares a bit with a wanted
one is dropped by the join that follows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import fresh, materialize, prepare, text_key
from lakebars.session import discard

WINDOW = 8               # words on either side of an entity
SUPPORT = 3              # different contexts that must show an entity and a term together
DISCLOSURE = 0.95        # share of an entity's information that a term may not reach
BITS = 1 << 24           # of the bitmaps: 2 MB whatever the corpus
SLICE = 1 << 20          # characters of a text whose words are listed at a time
HELD = 1 << 17           # words that a task counts before it reports

# The kinds in their order, the patterns, the bounds of lengths
KINDS = ("email", "ip", "card", "phone")
TERM = len(KINDS)        # the kind of added spans
LABELS = (*KINDS, "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

WORD = re.compile(r"\w+")
_SPACE = re.compile(r"\s")
_DIGIT = re.compile("[0-9]")


def _emails(text: str):
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, sought from each ``@``: linear in the text."""
    at, done = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in LOCAL:
            lo -= 1
        found = DOMAIN.match(text, at + 1) if lo < at else None
        if found:
            done = found.end()
            yield lo, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns' matches, sorted; leftmost and not overlapping within a kind."""
    found = [(lo, 0, hi) for lo, hi in _emails(text)]
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= CARD_DIGITS[0]:
                digits = _digits(m.group())
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if PHONE_DIGITS[0] <= sum(c in "0123456789" for c in m.group()) <= PHONE_DIGITS[1]:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity(text: str, kind: int) -> str:
    """What a match names: spelling differences left out."""
    return f"{KINDS[kind]}:{text.lower() if kind == 0 else text if kind == 1 else _digits(text)}"


def blanked(text: str, spans) -> str:
    """The text with spaces in place of the spans: the same positions, no word of a span."""
    parts, done = [], 0
    for lo, _, hi in spans:
        lo = max(lo, done)
        if hi > lo:
            parts += [text[done:lo], " " * (hi - lo)]
            done = hi
    return "".join([*parts, text[done:]]) if parts else text


def words_before(text: str, at: int, n: int) -> list[tuple[int, int]]:
    """Places of the last ``n`` words that end before ``at``, looked for in as little text as needed."""
    size = 16 * n
    while True:
        lo = max(0, at - size)
        found = [(m.start(), m.end()) for m in WORD.finditer(text, lo, at)]
        if lo == 0 or len(found) > n or (found and found[0][0] > lo and len(found) == n):
            return found[-n:]
        size *= 4


def contexts(text: str, spans, window: int = WINDOW):
    """``(entity, context, terms)`` for each span: a hash of the words around it, and those not counted for the entity yet."""
    plain, counted = blanked(text, spans), {}
    for lo, kind, hi in spans:
        name = entity(text[lo:hi], kind)
        near = words_before(plain, lo, window) + [(m.start(), m.end()) for m in islice(WORD.finditer(plain, hi), window)]
        new = near[bisect_left(near, (counted.get(name, 0),)):]
        if near:
            counted[name] = max(counted.get(name, 0), near[-1][1])
        terms = Counter(plain[a:b].lower() for a, b in new)
        around = "\x00".join([str(len(new)), *[plain[a:b].lower() for a, b in near]])
        yield name, xxhash.xxh64_intdigest(around.encode("utf-8", "surrogatepass")) - (1 << 63), sorted(terms.items())


def pieces(text: str):
    """The pieces between white space, in lists from about ``SLICE`` characters each; no word goes beyond its piece."""
    lo = 0
    while lo < len(text):
        cut = _SPACE.search(text, lo + SLICE)
        hi = cut.start() if cut else len(text)
        yield text[lo:hi].split()
        lo = hi


def general(term: str) -> str:
    """What a term is generalised to."""
    return term[:2] + "*"


def bitmap(words: DataFrame, word_col: str) -> bytes:
    """The hashes of words as ``BITS`` bits, made by Spark: 64 bits a row, at most BITS / 64 rows reach the driver."""
    bit = F.pmod(F.xxhash64(word_col), F.lit(BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    rows = (words.select(F.floor(bit / 64).cast("int").alias("at"), one.alias("b")).groupBy("at")
            .agg(F.bit_or("b").alias("b")).collect())
    bits = np.zeros(BITS // 64, np.int64)
    for r in rows:
        bits[r["at"]] = r["b"]
    return bits.tobytes()


def maybe_in(bits: bytes, word: str) -> bool:
    """Whether a word may be one of the bitmap's: always for those, seldom for others."""
    bit = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) % BITS
    return bits[bit >> 3] >> (bit & 7) & 1 == 1


_BASE = "base array<struct<start:int,kind:int,end:int>>"
_BASE_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_TERMS_TYPE = pa.list_(pa.struct([("term", pa.string()), ("times", pa.int32())]))


def _found(rows: DataFrame, kind: str, window: int) -> DataFrame:
    """First pass: a row of base spans for each text and a row for each context of an entity."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            spans = [base_spans(text) for text in batch.column(3).to_pylist()]
            nothing = [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, _TERMS_TYPE)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], pa.array(
                [[dict(zip(("start", "kind", "end"), s)) for s in own] for own in spans], _BASE_TYPE), *nothing], names)
            held: list = []
            for i, own in enumerate(spans):
                if own:
                    for x in contexts(batch.column(3)[i].as_py(), own, window):
                        held.append(x)
                        if len(held) == 4096:
                            yield rows_of(held, batch)
                            held = []
            if held:
                yield rows_of(held, batch)

    def rows_of(held, batch):
        n = len(held)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, batch.column(0).type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, _BASE_TYPE),
             pa.array([x[0] for x in held]), pa.array([x[1] for x in held], pa.int64()),
             pa.array([[{"term": t, "times": c} for t, c in x[2]] for x in held], _TERMS_TYPE)], names)

    names = ["id", "a", "b", "base", "entity", "context", "terms"]
    return rows.select("id", "a", "b", "text").mapInArrow(
        run, f"id {kind}, a long, b long, {_BASE}, entity string, context long, terms array<struct<term:string,times:int>>")


def _frequencies(texts: DataFrame, wanted: bytes) -> DataFrame:
    """Second pass: how often the wanted words, and the wanted generalisations, occur; the total has a NULL word."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        counts, bits = Counter(), shared.value        # of pieces: their words are looked at once for each report

        def rows():
            words: Counter = Counter()
            for piece, n in counts.items():
                for word in WORD.findall(piece):
                    words[word.lower()] += n
            total, broad = words.total(), Counter()
            for word, n in words.items():
                broad[general(word)] += n
            own = {name: n for names in (words, broad) for name, n in names.items() if maybe_in(bits, name)}
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([*own, None], pa.string()),
                                               pa.array([*own.values(), total], pa.int64())], ["term", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in pieces(blanked(text, base_spans(text))):
                    counts.update(part)
                    if len(counts) > HELD:
                        yield rows()
        yield rows()

    return texts.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(found: DataFrame, texts: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """``term``, its greatest ``disclosure`` and ``general`` (NULL: to be removed), from the rows of the first pass."""
    # copies of a context collapse before anything is spread out
    kinds = (found.where(F.col("entity").isNotNull()).groupBy("entity", "context", "terms").agg(F.count(F.lit(1)).alias("n")))
    spread = materialize(kinds.select("entity", "n", F.inline("terms")).select(
        "entity", (F.col("n") * F.col("times")).alias("n"),
        F.explode(F.array("term", F.concat(F.substring("term", 1, 2), F.lit("*")))).alias("term"))
        .groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count(F.lit(1)).alias("contexts")), "pairs")
    own = spread.where(~F.col("term").endswith("*")).groupBy("entity").agg(F.sum("together").alias("near"))
    often = spread.where(F.col("contexts") >= support)
    terms = often.where(~F.col("term").endswith("*")).select("term").distinct()
    wanted = terms.unionByName(terms.select(F.concat(F.substring("term", 1, 2), F.lit("*")).alias("term"))).distinct()
    counts = materialize(_frequencies(texts, bitmap(wanted, "term")), "frequencies")
    total = counts.where(F.col("term").isNull()).select("n").first()
    total = total[0] if total else 0
    information = F.log2(F.lit(float(max(total, 1))) / F.col("near"))
    judged = (often.join(counts.where(F.col("term").isNotNull()), "term").join(own, "entity")
              .withColumn("disclosure", F.when(information > 0, 1 - F.log2(F.col("n") / F.col("together")) / information))
              .where(F.col("disclosure") >= disclosure))
    judged = materialize(judged.select("entity", "term", "disclosure"), "judged")
    single = judged.where(~F.col("term").endswith("*")).withColumn("general", F.concat(F.substring("term", 1, 2), F.lit("*")))
    broad = judged.where(F.col("term").endswith("*")).select("entity", F.col("term").alias("general"), F.lit(True).alias("told"))
    out = materialize(
        single.join(broad, ["entity", "general"], "left").groupBy("term", "general").agg(
            F.max("disclosure").alias("disclosure"), F.max(F.coalesce("told", F.lit(False))).alias("told"))
        .select("term", "disclosure", F.when(~F.col("told"), F.col("general")).alias("general")), "disclosing")
    for side in (spread, counts, judged):
        discard(side)
    return out


def _places(texts: DataFrame, terms: DataFrame) -> DataFrame | None:
    """Third pass: the places of disclosing terms by text, as ``(a, b, added)``; ``None`` if there are no such terms."""
    wanted = bitmap(terms, "term")
    if not any(wanted):
        return None
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        bits = shared.value

        def has(piece):
            return any(maybe_in(bits, word.lower()) for word in WORD.findall(piece))

        for batch in batches:
            texts = batch.column(2).to_pylist()
            told: dict = {}                         # by piece of this batch
            held: list = []
            for i, text in enumerate(texts):
                hit = False
                for part in pieces(text):
                    for piece in set(part):
                        if piece not in told:
                            told[piece] = has(piece)
                        hit = hit or told[piece]
                if not hit:
                    continue
                a, b = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for m in WORD.finditer(blanked(text, base_spans(text))):
                    word = m.group().lower()
                    if maybe_in(bits, word):
                        held.append((a, b, m.start(), m.end(), word))
                        if len(held) == 8192:
                            yield rows_of(held)
                            held = []
            if held:
                yield rows_of(held)

    def rows_of(held):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], ["a", "b", "start", "end", "term"])

    hits = texts.mapInArrow(run, "a long, b long, start int, end int, term string").distinct()   # copies of a text tell the same
    return (hits.join(terms.select("term", "general"), "term").groupBy("a", "b")
            .agg(F.collect_list(F.struct("start", F.lit(TERM).alias("kind"), "end", "general")).alias("added")))


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """One row per input row: ``id_col``, ``a`` and ``b`` (the text's key), ``base`` and ``spans``.

    ``base`` are the patterns' matches, ``spans`` those and the disclosing
    terms, both arrays of structs (start, kind, end, general) sorted by start
    and kind; positions are code points, ends exclusive, kinds as in
    ``LABELS``.  A NULL text counts as empty: no spans.  Equal texts have
    equal spans, repeated rows and ids are rows like others, an empty table
    gives no rows.  Other columns are ignored.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("k", text_key(F.col("text"))).select(
        "id", "text", "k.a", "k.b")
    kind = docs.schema[id_col].dataType.simpleString()
    found = materialize(_found(rows, kind, window), "private")
    terms = disclosing_terms(found, rows.select("text"), support, disclosure)
    base = found.where(F.col("base").isNotNull()).select("id", "a", "b", F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("string").alias("general"))).alias("base"))
    added = _places(rows.select("a", "b", "text"), terms)
    both = F.col("base")
    if added is not None:
        base = base.join(added, ["a", "b"], "left")
        both = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(base.schema["base"].dataType))))
    out = materialize(base.select(F.col("id").alias(id_col), "a", "b", "base", both.alias("spans")), "spans")
    for side in (found, terms):
        discard(side)
    return out


def spelled(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    label = F.array(*[F.lit(x) for x in LABELS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(label, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: str, spans) -> str:
    """The text with ``[KIND]`` in place of entities and disclosing terms generalised or left out."""
    parts, done = [], 0
    for s in spans:
        if s["start"] >= done:
            parts += [text[done:s["start"]], (s["general"] or "") if s["kind"] == TERM else f"[{LABELS[s['kind']].upper()}]"]
        done = max(done, s["end"])
    return "".join([*parts, text[done:]])


def sanitise(docs: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The documents with their texts sanitised; all columns as they were, a NULL text stays NULL.

    Texts meet their spans once, on a 128-bit key; equal texts share one row of spans.
    """
    id_col = fresh("_id", docs.columns)
    spans = private_spans(docs.select(F.lit(0).alias(id_col), text_col), id_col, text_col, **params)
    a, b, found = (fresh(n, docs.columns) for n in ("_a", "_b", "_spans"))
    spans = spans.where(F.size("spans") > 0).select(F.col("a").alias(a), F.col("b").alias(b), "spans").groupBy(a, b).agg(
        F.any_value("spans").alias(found))
    key = text_key(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.withColumns({a: key["a"], b: key["b"]}).join(spans, [a, b], "left").select(*docs.columns, found)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [t if t is None or not s else replaced(t, s)
                     for t, s in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    names = docs.columns
    return rows.mapInArrow(run, docs.schema)
