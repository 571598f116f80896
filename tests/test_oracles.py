"""Every query with an oracle matches DuckDB on the sf0.001 tables."""

import pytest

from tools.oracle_check import digest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL

SQL = oracle_sql()
QS = queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = QS[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    g, w = digest(got), digest(want)
    assert g[1] == w[1], f"columns differ: {set(g[1]) ^ set(w[1])}"
    assert g[0] == w[0], f"row counts {g[0]} vs {w[0]}"
    assert g[2] == w[2], "values differ"


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["subject_id", "admission_id"]
