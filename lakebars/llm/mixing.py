"""Soft-membership mixing: document rates whose expected domain totals match target weights.

A naive Bayes classifier, fitted on a bounded sample of a labelled table,
gives each document a posterior over the domains.  A document of n words
counts n times its posterior toward the domains' totals.  Nonnegative rates
(expected copies of each document) are then fitted by projected gradient
least squares: every step adds up the domains' totals over all documents,
compares them with the targets, moves each rate against the gradient and
cuts it off at zero.  The steps are scaled by what the earlier ones showed of
the domains' overlap (quasi-Newton), so that soft memberships get to the
targets too.  Only the totals, one number for each domain, reach the driver.
Everything here is DataFrame functions.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import ASCII_SPACE, draw, fresh, lower_ascii, materialize, prepare, text_key

BUCKETS = 1 << 13        # hashed words of the classifier
SAMPLE = 8000            # labelled documents fitted on at most
DOMAINS = 256            # domains of a labelled table at most; more is an error
SMOOTH = 0.5
EVIDENCE_WORDS = 20.0    # a text's evidence counts as that of so many words at most
TEMPERATURE = 0.5        # default targets: expected shares to this power
STEPS = 300             # sums over all documents at most; a fit that needs more is reported
RIDGE = 1e-8             # weight of the rates' distance from one beside that of the totals from the targets
TOLERANCE = 1e-6         # largest distance of a domain's share from its target


def word_rows(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """One row per word (white-space separated, A-Z lower-cased), as a hash bucket."""
    words = F.split(F.translate(lower_ascii(F.col(text_col)), ASCII_SPACE, " " * len(ASCII_SPACE)), " ")
    rows = docs.select(*keep, F.explode(words).alias("word")).where(F.col("word") != "")
    return rows.select(*keep, F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket"))


def fit_classifier(labelled: DataFrame, text_col: str, domain_col: str, sample: int = SAMPLE,
                   seed: int = 3, id_col: str | None = None) -> tuple[list[str], list[float], DataFrame | None]:
    """Domains, their log shares, and ``(bucket, scores)``: each domain's log chance of a word.

    Fitted on at most ``sample`` labelled rows chosen by a hash of the id and
    the text; rows that have both in common count once (without ``id_col``,
    copies of a text do).
    The table has ``BUCKETS`` rows, whatever the input.
    """
    rows = labelled.where(F.col(domain_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(domain_col).cast("string").alias("domain"), F.col(text_col).cast("string").alias("text"),
        *([F.col(id_col).alias("id")] if id_col else []))
    counts = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n")).limit(DOMAINS + 1).collect()}
    if len(counts) > DOMAINS:
        raise ValueError(f"the labelled table has more than {DOMAINS} domains")
    domains, total = sorted(counts), sum(counts.values())
    if not domains:
        return [], [], None
    chosen = draw(rows.withColumn("all", F.lit(1)), "all", rows.columns, sample, seed)
    seen = word_rows(chosen, "text", ["domain"]).groupBy("bucket", "domain").agg(F.count(F.lit(1)).alias("n"))
    wide = seen.groupBy("bucket").agg(*[F.sum(F.when(F.col("domain") == d, F.col("n"))).alias(f"d{i}")
                                        for i, d in enumerate(domains)])
    every = chosen.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    wide = materialize(every.join(wide, "bucket", "left").fillna(0), "mixing-words")
    sums = wide.agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(len(domains))]).first()
    scores = [F.log((F.col(f"d{i}") + SMOOTH) / (sums[f"d{i}"] + SMOOTH * BUCKETS)).alias(f"s{i}")
              for i in range(len(domains))]
    return domains, [math.log(counts[d] / total) for d in domains], wide.select("bucket", *scores)


def memberships(docs: DataFrame, text_col: str, id_col: str, domains: list[str], priors: list[float],
                scores: DataFrame | None) -> DataFrame:
    """By distinct row identity (``id``, ``ka``, ``kb``): rows, words ``n``, posteriors ``p0`` ....

    Texts without words have the priors as posteriors.
    """
    key = text_key(F.col("text"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", key["a"].alias("ka"), key["b"].alias("kb"), "text")
    names = [f"s{i}" for i in range(len(domains))]
    known = word_rows(rows, "text", ["id", "ka", "kb"]).join(F.broadcast(scores), "bucket")  # BUCKETS rows
    none = rows.select("id", "ka", "kb", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("rows"),
                       *[F.lit(0.0).alias(s) for s in names])
    some = known.groupBy("id", "ka", "kb").agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("rows"), *[F.sum(s).alias(s) for s in names])
    both = none.unionByName(some).groupBy("id", "ka", "kb").agg(
        *[F.sum(c).alias(c) for c in ("n", "rows", *names)])
    # repeated rows: their words were counted together
    both = both.withColumn("n", (F.col("n") / F.col("rows")).cast("long"))
    weight = F.when(F.col("n") > 0, F.least(F.lit(1.0), EVIDENCE_WORDS / F.col("n")) / F.col("rows")).otherwise(0.0)
    odds = [F.col(s) * weight + p for s, p in zip(names, priors)]
    most = F.greatest(*odds) if len(odds) > 1 else odds[0]
    chances = [F.exp(o - most) for o in odds]
    both = both.select("id", "ka", "kb", "n", "rows", *[c.alias(f"e{i}") for i, c in enumerate(chances)])
    norm = sum((F.col(f"e{i}") for i in range(1, len(names))), F.col("e0"))
    return both.select("id", "ka", "kb", "n", "rows", *[(F.col(f"e{i}") / norm).alias(f"p{i}")
                                                        for i in range(len(names))])


def fit_rates(members: DataFrame, k: int, weights: list[float] | None, steps: int = STEPS,
              tolerance: float = TOLERANCE) -> tuple[DataFrame, dict]:
    """``members`` with ``rate``, and what the fit reached.

    Least squares over the domains' totals, each relative to the total it
    has at rate one.  A rate is one less the document's posteriors times the
    domains' pulls, cut off at zero.  The first step moves the pulls by the
    gradient, for which a step length of one cannot overshoot; later ones
    follow a quasi-Newton (BFGS) direction, the length found by the sign and
    size of the slope.  Ends when all totals are within ``tolerance`` of all
    words, or at the least squares solution if the targets cannot be reached;
    ``gap`` is the largest distance left, as a share of all words.
    """
    def totals(pulls) -> np.ndarray:
        row = members.agg(*[F.sum(rate_of(pulls) * F.col("n") * F.col("rows") * F.col(f"p{i}")) for i in range(k)]).first()
        return np.array([float(x or 0.0) for x in row])

    def rate_of(pulls) -> Column:
        if not np.any(pulls):
            return F.lit(1.0)
        return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.lit(float(x)) * F.col(f"p{i}") for i, x in enumerate(pulls)),
                                                       F.lit(0.0)))

    at, used = np.zeros(k), 0
    have = totals(at)
    words = float(have.sum())
    if weights is None:
        raised = [(t / words) ** TEMPERATURE if words and t > 0 else 0.0 for t in have]
        weights = [r / sum(raised) if sum(raised) else 0.0 for r in raised]
    goal = np.array(weights) * words
    scale = np.where(have > 0, 1 / np.where(have > 0, have, 1.0), 0.0)
    gap = lambda t: float(np.abs(t - goal).max() / words) if words else 0.0
    error = lambda t: float((scale * (t - goal) ** 2).sum())
    slope_at = lambda pulls, t: (scale > 0) * (goal - t + RIDGE * have * pulls)
    best, now, inverse = (at, have), have, np.diag(scale)
    slope = slope_at(at, now)
    while gap(best[1]) > tolerance and used < steps and np.abs(slope).max() > tolerance / 100 * words:
        way = -inverse @ slope
        down = slope @ way
        if not down < 0:   # rounding spoilt the scaling
            inverse = np.diag(scale)
            way = -inverse @ slope
            down = slope @ way
        low, high, length = (0.0, down), None, 1.0
        while used < steps:
            there = at + length * way
            now, used = totals(there), used + 1
            if error(now) < error(best[1]):
                best = (there, now)
            new = slope_at(there, now)
            rise = new @ way
            if gap(now) <= tolerance or abs(rise) <= 0.5 * abs(down):
                break
            if rise < 0:
                low = (length, rise)
            else:
                high = (length, rise)
            if high is None:
                length *= min(10.0, max(1.5, down / (down - rise))) if rise > down else 10.0
            else:
                part = low[1] / (low[1] - high[1])
                length = low[0] + min(0.9, max(0.1, part)) * (high[0] - low[0])
        step, change = there - at, new - slope
        at, slope = there, new
        if step @ change > 1e-14 * np.linalg.norm(step) * np.linalg.norm(change):
            rho = 1 / (step @ change)
            left = np.eye(k) - rho * np.outer(step, change)
            inverse = left @ inverse @ left.T + rho * np.outer(step, step)
    at, now = best
    return members.withColumn("rate", rate_of(at)), {
        "steps": used, "targets": goal.tolist(), "totals": now.tolist(), "before": have.tolist(), "gap": gap(now)}


ADDED = {"n_words": "n_words", "domain": "domain", "posteriors": "posteriors", "rate": "rate"}


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id",
        text_col: str = "text", domain_col: str = "lang", keep: list[str] | None = None, sample: int = SAMPLE,
        names: dict[str, str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all rows) with ``n_words``, the likeliest ``domain``, ``posteriors`` and ``rate``.

    ``rate`` is the number of times the document should be seen per pass:
    with it the expected words of the domains are in the proportions of
    ``targets`` (any nonnegative numbers by domain; domains without one get
    zero; by default the square roots of the shares the input has), at the
    same total.  ``posteriors`` is in the order of the sorted domains.  NULL
    and empty texts have no words, the overall shares as posteriors, and the
    rate these give.  Repeated rows each get the rate.  Without labelled rows
    every rate is one and ``domain`` is NULL.
    """
    spark = docs.sparkSession
    prepare(spark)
    keep = docs.columns if keep is None else keep
    names = {**{k: fresh(v, keep) for k, v in ADDED.items()}, **(names or {})}
    domains, priors, scores = fit_classifier(labelled, text_col, domain_col, sample,
                                             id_col=id_col if id_col in labelled.columns else None)
    if not domains:
        size = F.size(F.filter(F.split(F.translate(F.coalesce(F.col(text_col), F.lit("")), ASCII_SPACE,
                                                   " " * len(ASCII_SPACE)), " "), lambda w: w != ""))
        return docs.select(*keep, size.cast("long").alias(names["n_words"]),
                           F.lit(None).cast("string").alias(names["domain"]),
                           F.array().cast("array<double>").alias(names["posteriors"]),
                           F.lit(1.0).alias(names["rate"]))
    members = materialize(memberships(docs, text_col, id_col, domains, priors, scores), "mixing-members")
    weights = None
    if targets is not None:
        asked = [max(0.0, float(targets.get(d, 0.0))) for d in domains]
        weights = [w / sum(asked) for w in asked] if sum(asked) else None
    rated, fit = fit_rates(members, len(domains), weights)
    if fit["gap"] > TOLERANCE:
        warnings.warn(f"mixing: the domains' totals stay {fit['gap']:.2g} of all words off their targets after "
                      f"{fit['steps']} steps", RuntimeWarning, stacklevel=2)
    posteriors = F.array(*[F.col(f"p{i}") for i in range(len(domains))])
    likeliest = F.element_at(F.array(*[F.lit(d) for d in domains]),
                             F.array_position(posteriors, F.array_max(posteriors)).cast("int"))
    facts = rated.select(F.col("id").alias("_m_id"), F.col("ka").alias("_m_ka"), F.col("kb").alias("_m_kb"),
                         F.col("n").alias("_m_n"), likeliest.alias("_m_domain"), posteriors.alias("_m_p"),
                         F.col("rate").alias("_m_rate"))
    facts = facts.toDF(*[fresh(c, docs.columns) for c in facts.columns])
    m_id, m_ka, m_kb, m_n, m_domain, m_p, m_rate = facts.columns
    key = text_key(F.col(text_col).cast("string"))
    keys = [fresh(c, [*docs.columns, *facts.columns]) for c in ("_d_id", "_d_ka", "_d_kb")]
    d_id, d_ka, d_kb = keys
    # only what is returned is shuffled: the text's identity stands for it
    rows = docs.select(*keep, F.col(id_col).alias(d_id), key["a"].alias(d_ka), key["b"].alias(d_kb))
    joined = rows.join(facts.hint("shuffle_hash"), F.col(d_id).eqNullSafe(F.col(m_id)) & (
        F.col(d_ka) == F.col(m_ka)) & (F.col(d_kb) == F.col(m_kb)), "left")
    return joined.select(*keep, F.col(m_n).alias(names["n_words"]), F.col(m_domain).alias(names["domain"]),
                         F.col(m_p).alias(names["posteriors"]), F.col(m_rate).alias(names["rate"]))
