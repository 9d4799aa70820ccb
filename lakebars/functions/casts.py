"""Lenient casts of raw text fields.

Spark 4 runs with ANSI on, where a plain cast raises on bad text.  The raw
layer is untrusted, so every cast is a ``try_cast``: a bad value becomes NULL
and the rest of the row survives.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_ntz(c) -> Column:
    return _col(c).try_cast("timestamp_ntz")


def to_double(c) -> Column:
    """Text -> double; ``NaN`` and the infinities are no measurements and become NULL."""
    x = _col(c).try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def to_long(c) -> Column:
    """Text -> bigint.

    Integer text is cast directly so values above 2**53 stay exact; text such
    as ``1e3`` or ``1.5`` goes through double (truncating like a numeric cast).
    """
    c = _col(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
