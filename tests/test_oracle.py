"""Every driver query against its DuckDB SQL on the smallest tables."""

import pytest

from tools.compare import canon, duck

SF = "/root/testdata/sf0.001"


def _names():
    import __spark_entry__ as E

    return list(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every query has an oracle"
    cur = duck(SF).execute(sql)
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["job", "message_id", "pos", "href", "file_name"]
    assert df.count() >= 0
