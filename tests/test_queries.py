"""Every query against the same in SQL, on the smallest tables."""

import math

import pytest

from caloris.plans.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def rows(frame):
    """Rows as sorted tuples of plain values, columns by name."""

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
            return None
        if hasattr(v, "isoformat"):
            return v.isoformat()[:10]
        return float(v) if not isinstance(v, (str, bytes)) else v

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SMALL).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_queries_without_sql_run(spark):
    for name in set(QUERIES) - set(SQL):
        assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
