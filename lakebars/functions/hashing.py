"""Change-detection hash (X9-X11) and surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakebars.schemas import ISSUER_ATTRIBUTES


def row_hash(*columns: str) -> Column:
    """md5 of the attributes joined by '||'.

    ``concat_ws`` skips NULLs, so moving a NULL between two attributes yields
    the same hash; this is the dimension's change rule and is kept on purpose.
    Booleans render as 'true'/'false'.
    """
    cols = columns or tuple(ISSUER_ATTRIBUTES)
    return F.md5(F.concat_ws("||", *[F.col(c).cast("string") for c in cols]))


def surrogate_id(*columns) -> Column:
    """Deterministic 64-bit key of a version; needs no global ordering."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in columns])
