"""JDBC reader options (S4, S9); no database is started, only the options are checked."""

import pytest

from lakebars.sources.jdbc import jdbc_options


def test_query_read():
    o = jdbc_options("jdbc:x://h/db", query="SELECT * FROM emitents")
    assert o["query"] == "SELECT * FROM emitents" and o["fetchsize"] == "50000" and "dbtable" not in o


def test_partitioned_query_read_uses_subquery():
    o = jdbc_options("jdbc:x://h/db", query="SELECT id, v FROM t", partition_column="id",
                     lower_bound=0, upper_bound=1000, num_partitions=16)
    assert o["dbtable"] == "(SELECT id, v FROM t) q"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "1000", "16")


def test_table_read_and_errors():
    assert jdbc_options("jdbc:x://h/db", table="emitents")["dbtable"] == "emitents"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", table="t", partition_column="id")
