"""RDBMS extract (S4, S9) through Spark's JDBC source.

The chunked cursor of a single-process extractor becomes a partitioned
read: ``numPartitions`` range queries over a numeric column run in
parallel on the executors, each fetching ``fetchsize`` rows per round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FETCH_SIZE = 50_000


def jdbc_options(url: str, query: str | None = None, table: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = DEFAULT_FETCH_SIZE,
                 properties: dict | None = None) -> dict:
    """Reader options for a query (S4) or a whole table."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    # A partitioned read needs a subquery alias rather than the `query` option.
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts["dbtable"] = table if table else f"({query}) q"
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    elif query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table
    opts.update(properties or {})
    return opts


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """``SELECT ...`` or ``SELECT * FROM table`` as a DataFrame."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()
