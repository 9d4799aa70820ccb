"""SCD2 merge of a snapshot into a versioned dimension.

A snapshot says what every ticker in it was from ``run_ts`` on.  Per ticker,
against the version that covers ``run_ts``:

* no version covers it -> new version from 1900-01-01 (from ``run_ts`` when
  the ticker has versions that ended before), up to the ticker's next
  version if there is one;
* same attribute hash -> nothing;
* different hash -> the covering version ends at ``run_ts`` and a new one
  follows up to the covering version's old end; both use one timestamp, so
  they meet exactly.  If the covering version starts at ``run_ts`` itself,
  its attributes are replaced;
* ticker missing from the snapshot -> nothing (no delete detection).

For the newest run the covering version is the current one.  An older run
that comes late, or again, finds the version of its own time, so any order
and any repetition of runs gives versions that neither overlap nor invert.

``strict=False`` keeps the loose behaviour of the original SQL: NULL
tickers insert a new version on every run, repeated tickers insert one
current version per source row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.functions.hashing import row_hash, surrogate_id
from lakebars.functions.params import END_OF_TIME, START_OF_TIME, ts_lit
from lakebars.schemas import DIMENSION, ISSUER_ATTRIBUTES

DIM_COLUMNS = [f.name for f in DIMENSION.fields]


@dataclass
class Scd2Frames:
    changed: DataFrame      # tickers whose attributes changed (J2)
    new: DataFrame          # snapshot rows without a current version (J3)
    closed: DataFrame       # current versions closed by this run
    opened: DataFrame       # versions opened by this run
    kept: DataFrame         # current versions left as they are

    @property
    def current(self) -> DataFrame:
        """The current versions after the run."""
        return self.kept.unionByName(self.opened)


def empty_dimension(spark) -> DataFrame:
    return spark.createDataFrame([], DIMENSION)


def snapshot_hashes(snapshot: DataFrame) -> DataFrame:
    return snapshot.select("ticker", *ISSUER_ATTRIBUTES, row_hash(*ISSUER_ATTRIBUTES).alias("row_hash"))


def _version(df: DataFrame, valid_from) -> DataFrame:
    return df.select(
        surrogate_id(F.col("ticker"), valid_from).alias("emitent_id"),
        "ticker", *ISSUER_ATTRIBUTES,
        valid_from.alias("valid_from"),
        ts_lit(END_OF_TIME).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_frames(current: DataFrame, snapshot: DataFrame, run_ts, strict: bool = True,
                history_tickers: DataFrame | None = None) -> Scd2Frames:
    """Split the merge into its parts.  ``current`` holds the versions with
    ``is_current``; ``history_tickers`` (strict mode) the tickers that have
    closed versions."""
    run = ts_lit(run_ts)
    src = snapshot_hashes(checked_snapshot(snapshot) if strict else snapshot)
    src_keyed = src.where(F.col("ticker").isNotNull())
    src_null = src.where(F.col("ticker").isNull())
    cur = current.where(F.col("is_current")).select(*DIM_COLUMNS, row_hash(*ISSUER_ATTRIBUTES).alias("row_hash"))
    cur_keys = cur.select("ticker", F.col("row_hash").alias("cur_hash"))

    changed = (src_keyed.join(cur_keys, "ticker", "inner")
               .where(F.col("row_hash") != F.col("cur_hash"))
               .select("ticker").distinct())
    new = src_keyed.join(cur_keys.select("ticker"), "ticker", "left_anti")

    closed = (cur.join(changed, "ticker", "left_semi")
              .withColumn("valid_to", run).withColumn("is_current", F.lit(False))
              .select(*DIM_COLUMNS))
    kept = cur.join(changed, "ticker", "left_anti").select(*DIM_COLUMNS)

    reopened = _version(src_keyed.join(changed, "ticker", "left_semi"), run)
    if strict and history_tickers is not None:
        seen = history_tickers.select("ticker").distinct().withColumn("_seen", F.lit(True))
        start = F.when(F.col("_seen"), run).otherwise(ts_lit(START_OF_TIME))
        first = _version(new.join(seen, "ticker", "left"), start)
    else:
        first = _version(new, ts_lit(START_OF_TIME))
    opened = reopened.unionByName(first)
    if not strict:
        opened = opened.unionByName(_version(src_null, ts_lit(START_OF_TIME)))
    return Scd2Frames(changed=changed, new=new.select("ticker", *ISSUER_ATTRIBUTES),
                      closed=closed, opened=opened, kept=kept)


SOURCE_ROWS = "_source_rows"   # snapshot rows behind a version's ticker
TOUCHED = "_touched"           # whether the merge made or changed the version


def _one_row_each(snapshot: DataFrame) -> DataFrame:
    """The snapshot by ticker: attributes, and how many rows the ticker has (NULL tickers count as bad)."""
    rows = snapshot.groupBy("ticker").agg(F.first(F.struct(*ISSUER_ATTRIBUTES)).alias("src"),
                                          F.count(F.lit(1)).alias(SOURCE_ROWS))
    return rows.withColumn("src_hash", F.md5(F.concat_ws("||", *[
        F.col("src")[a].cast("string") for a in ISSUER_ATTRIBUTES])))


def _refuse(bad, value):
    """``value``, unless ``bad``: then the query that computes it fails."""
    message = F.lit("issuer snapshot: duplicate or NULL tickers")
    return F.when(bad, F.raise_error(message).cast("string")).otherwise(value)


def checked_snapshot(snapshot: DataFrame) -> DataFrame:
    """The snapshot; running it fails if a ticker is repeated or NULL."""
    rows = _one_row_each(snapshot)
    bad = (F.col(SOURCE_ROWS) > 1) | F.col("ticker").isNull()
    return rows.select(_refuse(bad, F.col("ticker")).alias("ticker"), "src.*")


def strict_merge(versions: DataFrame, snapshot: DataFrame, run_ts, earlier_tickers: DataFrame | None = None,
                 defer_key_check: bool = False) -> DataFrame:
    """The given versions after the merge, in one pass: one aggregate of each side and one full outer join.

    ``versions`` must hold every version that ends after ``run_ts``, whole
    dimension or not; all of them are returned, merged.  ``earlier_tickers``
    names tickers that have versions which ended before and are not among
    ``versions``.  Versions of a NULL ticker pass unchanged, spread over the
    tasks.

    The snapshot's keys must be unique and not NULL: by default the query
    fails when it runs.  With ``defer_key_check`` the output carries
    :data:`SOURCE_ROWS` and :data:`TOUCHED` for the caller to check while
    writing, and NULL tickers of the snapshot stay visible.
    """
    run = ts_lit(run_ts)
    fields = [c for c in DIM_COLUMNS if c != "ticker"]
    spread = F.when(F.col("ticker").isNull(), F.xxhash64(*fields)).otherwise(F.lit(0).cast("bigint"))
    held = versions.groupBy("ticker", spread.alias("_spread")).agg(
        F.collect_list(F.struct(*fields, F.lit(False).alias(TOUCHED))).alias("held"))
    src = _one_row_each(snapshot)
    if earlier_tickers is not None:
        src = src.join(earlier_tickers.select("ticker").distinct().withColumn("earlier", F.lit(True)), "ticker", "left")
    else:
        src = src.withColumn("earlier", F.lit(None).cast("boolean"))
    j = held.join(src, "ticker", "full_outer")
    kind = held.schema["held"].dataType
    j = j.withColumn("held", F.coalesce("held", F.array().cast(kind)))

    covers = lambda v: (v["valid_from"] <= run) & (run < v["valid_to"])
    j = j.withColumn("cover", F.try_element_at(F.filter("held", covers), F.lit(1)))
    cover, given = F.col("cover"), F.col("src").isNotNull()
    old_hash = F.md5(F.concat_ws("||", *[cover[a].cast("string") for a in ISSUER_ATTRIBUTES]))
    changed = given & cover.isNotNull() & (old_hash != F.col("src_hash"))
    new = given & cover.isNull()

    def version(source, valid_from, valid_to, current, emitent_id):
        return F.struct(emitent_id.alias("emitent_id"), *[source[a].alias(a) for a in ISSUER_ATTRIBUTES],
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"), current.alias("is_current"),
                        F.lit(True).alias(TOUCHED))

    before = F.coalesce(F.exists("held", lambda v: v["valid_to"] <= run), F.lit(False)) | F.coalesce(
        "earlier", F.lit(False))
    start = F.when(before, run).otherwise(ts_lit(START_OF_TIME))
    following = F.array_min(F.transform(F.filter("held", lambda v: v["valid_from"] > run), lambda v: v["valid_from"]))
    closed = F.when(changed & (cover["valid_from"] < run), version(
        cover, cover["valid_from"], run, F.lit(False), cover["emitent_id"]))
    opened = F.when(changed, version(F.col("src"), run, cover["valid_to"], cover["is_current"],
                                     surrogate_id(F.col("ticker"), run)))
    first = F.when(new, version(F.col("src"), start, F.coalesce(following, ts_lit(END_OF_TIME)), following.isNull(),
                                surrogate_id(F.col("ticker"), start)))
    # the covering version gives way; an identical closed one is there already after a crash
    kept = F.filter("held", lambda v: ~F.coalesce(changed & (covers(v) | (
        (v["valid_from"] == cover["valid_from"]) & (v["valid_to"] == run))), F.lit(False)))
    made = F.filter(F.array(closed, opened, first), lambda v: v.isNotNull())
    rows = j.select("ticker", F.explode(F.concat(kept, made)).alias("v"),
                    F.coalesce(SOURCE_ROWS, F.lit(0)).alias(SOURCE_ROWS))
    out = rows.select("ticker", "v.*", SOURCE_ROWS)
    if defer_key_check:
        return out.select(*DIM_COLUMNS, SOURCE_ROWS, TOUCHED)
    bad = (F.col(SOURCE_ROWS) > 1) | (F.col("ticker").isNull() & (F.col(SOURCE_ROWS) > 0))
    return out.withColumn("ticker", _refuse(bad, F.col("ticker"))).select(*DIM_COLUMNS)


def scd2_merge(dimension: DataFrame, snapshot: DataFrame, run_ts, strict: bool = True) -> DataFrame:
    """The whole dimension after the merge."""
    if strict:
        return strict_merge(dimension.select(*DIM_COLUMNS), snapshot, run_ts)
    history = dimension.where(~F.col("is_current")).select(*DIM_COLUMNS)
    frames = scd2_frames(dimension.where(F.col("is_current")), snapshot, run_ts, strict=False)
    return history.unionByName(frames.closed).unionByName(frames.current)
