"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's features are the hashed byte n-grams of its lower-cased words,
averaged over the whole text.  The model (embeddings of the hash buckets,
and a softmax on their average) is trained by stochastic gradient descent in
numpy on a bounded sample of labelled texts; a part of the sample held back
sets the softmax's temperature and the score below which a prediction is
marked as rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import draw, prepare

BUCKETS = 1 << 13
ORDERS = (2, 3, 4)
DIM = 16
SAMPLE = 1500            # labelled rows of each language at most
ALL_SAMPLES = 24_000     # texts fitted on at most, all languages together
LANGUAGES = 1_000        # languages at most; more is an error
EPOCHS = 12
RATE = 4.0
BATCH = 32
PRECISION = 0.99         # of the predictions that are not rejected, on the part held back
SLICE = 1 << 20          # bytes of a text whose n-grams are counted at a time
UNKNOWN = "und"

#: bytes that are no part of a word become spaces
_WORDS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def features(text: str) -> np.ndarray:
    """Shares of the hash buckets among the byte n-grams of the text's words, a space around each."""
    data = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_WORDS).split()) + b" "
    counts = np.zeros(BUCKETS, np.int64)
    most = max(ORDERS) - 1
    for lo in range(0, len(data), SLICE):
        part = np.frombuffer(data[max(0, lo - most):lo + SLICE], np.uint8).astype(np.uint32)
        old = min(lo, most)   # bytes of the slice before, whose own n-grams are counted already
        for n in ORDERS:
            h = np.full(max(0, len(part) - n + 1), n, np.uint32)
            for k in range(n):
                h = h * np.uint32(0x01000193) + part[k:k + len(h)]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            counts += np.bincount((h >> np.uint32(19))[max(0, old - n + 1):], minlength=BUCKETS)
    return counts / max(1, counts.sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, seed: int = 7,
          epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and softmax weights by mini-batch SGD; ``rows`` are sparse (buckets, shares)."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM))
    weights = rng.normal(0, 0.1, (DIM, classes))
    steps, step = epochs * -(-len(rows) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            part, rate = order[lo:lo + BATCH], RATE * (1 - step / steps)
            x = np.zeros((len(part), BUCKETS))
            for row, i in enumerate(part):
                x[row, rows[i][0]] = rows[i][1]
            hidden = x @ embed * SCALE
            error = _softmax(hidden @ weights)
            error[np.arange(len(part)), labels[part]] -= 1
            error /= len(part)
            back = error @ weights.T * SCALE
            weights -= rate * hidden.T @ error
            embed -= rate * x.T @ back
            step += 1
    return embed, weights


SCALE = 10.0   # averages of small shares are scaled before the softmax


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The temperature with the least log loss, and the score from which predictions are right often enough."""
    if not len(labels):
        return 1.0, 0.0
    loss = {t: -np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean()
            for t in np.geomspace(0.25, 8, 21)}
    temperature = float(min(loss, key=loss.get))
    scores = _softmax(logits / temperature)
    right = scores.argmax(axis=1) == labels
    order = np.argsort(-scores.max(axis=1))
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(share >= PRECISION)
    if not len(enough):
        return temperature, 1.0
    return temperature, float(scores.max(axis=1)[order][enough[-1]])


def fit(labelled: DataFrame, text_col: str, lang_col: str, sample: int = SAMPLE, seed: int = 7,
        id_col: str | None = None) -> dict:
    """A model from at most ``sample`` rows of each language, chosen by a hash of the id and the text.

    Of many languages fewer rows each are taken, ``ALL_SAMPLES`` in all; more
    than ``LANGUAGES`` raise.

    Rows that have both in common count once (without ``id_col``, copies of a text do).

    Features are made by the tasks; the driver gets the chosen rows'
    hashed features only (at most BUCKETS of each).
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        *([F.col(id_col).alias("id")] if id_col else []))
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if len(langs) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    if not langs:
        return {"langs": [], "matrix": np.zeros((BUCKETS, 0)), "temperature": 1.0, "least": 0.0}
    chosen = draw(rows, "lang", rows.columns[1:], max(1, min(sample, ALL_SAMPLES // len(langs))), seed)

    def run(batches):
        for batch in batches:
            sparse = []
            for text in batch.column(1).to_pylist():
                f = features(text)
                at = np.flatnonzero(f)
                sparse.append((at.astype(np.int32), f[at].astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a for a, _ in sparse], pa.list_(pa.int32())),
                 pa.array([s for _, s in sparse], pa.list_(pa.float32()))], ["lang", "at", "share"])

    got = chosen.mapInArrow(run, "lang string, at array<int>, share array<float>").toArrow()
    number = {lang: i for i, lang in enumerate(langs)}
    sparse = [(np.asarray(a.values, np.int64), np.asarray(s.values, np.float64))
              for a, s in zip(got.column("at"), got.column("share"))]
    labels = np.array([number[x] for x in got.column("lang").to_pylist()], np.int64)
    # an order of its own, so that the model does not depend on how the tasks were dealt out
    keys = [(int(y), a.tobytes(), s.tobytes()) for (a, s), y in zip(sparse, labels)]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    sparse, labels = [sparse[i] for i in order], labels[order]
    back = np.random.default_rng(seed).random(len(sparse)) < 0.2
    if back.all() or not back.any():
        back[:] = False
    own = [i for i in range(len(sparse)) if not back[i]]
    embed, weights = train([sparse[i] for i in own], labels[own], len(langs), seed)
    matrix = embed @ weights * SCALE
    logits = np.array([share @ matrix[at] for at, share in sparse])
    temperature, least = calibrate(logits[back], labels[back])
    return {"langs": langs, "matrix": matrix, "temperature": temperature, "least": least}


def predict(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    ``lang_pred`` is ``und`` with score 0 where the text is NULL or has no
    letter (or no language was learned); these are rejected too.
    """
    prepare(docs.sparkSession)
    keep = keep or [c for c in docs.columns if c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = len(keep)

    def run(batches):
        own = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(at).to_pylist():
                if text is None or not own["langs"] or not any(map(str.isalpha, text)):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = _softmax((features(text) @ own["matrix"] / own["temperature"])[None])[0]
                langs.append(own["langs"][int(p.argmax())])
                scores.append(float(p.max()))
            rejected = [x == UNKNOWN or s < own["least"] for x, s in zip(langs, scores)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(at)), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())], [*keep, "lang_pred", "score", "rejected"])

    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **params) -> DataFrame:
    """One row per input row: ``id_col``, ``held_out``, ``lang_pred``, ``score``, ``rejected``.

    Learns from the rows that are not held out and have a language.  Rows
    with a NULL id are not held out.  No rows give no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(id_col, held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"))
    model = fit(rows.where(~F.col("held_out")), "text", "lang", **{"id_col": id_col, **params})
    return predict(rows.drop("lang"), model, "text", [id_col, "held_out"])
