"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from mise.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import os
    if not os.path.exists(SF):
        pytest.skip("test tables not present")
    from tools.oracle_check import duck
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    from tools.oracle_check import rows_of
    got = QUERIES[key](spark, SF).toPandas()
    want = con.execute(ORACLES[key]).fetchdf()
    c1, r1 = rows_of(got)
    c2, r2 = rows_of(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["clip_id", "n2"] and df.count() > 0


def test_sql_over_registered_views_matches_operators(spark):
    from mise.operators.profile import class_counts
    from mise.plans import standins as S
    S.register_views(spark, SF)
    sql = spark.sql("select verb, count(*) n from clips where split = 'train' group by verb "
                    "order by n desc, verb limit 5").collect()
    api = class_counts(S.clips(spark, SF).filter("split = 'train'"), "verb", k=5).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in api]
    assert spark.sql("select count(*) from frames").first()[0] == S.frames(spark, SF).count()
