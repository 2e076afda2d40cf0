"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import pytest

from compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["CategoryGroup", "Category", "TongUser", "UserTrungThanh", "UserNguyCo", "TiLe_TrungThanh"]
    assert df.count() >= 0
    from viewpulse import oracle, registry

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(oracle.queries_sql()) == set(registry.build())
