"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tests.comparing import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.REGISTRY, driver.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    # approximate by design: results depend on how rows were partitioned
    assert set(QUERIES) - set(ORACLES) == {"distinct_agents_sketch", "duration_stats_sketch"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(name, spark, con):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() > 0
    assert result.columns[:3] == ["cod_distribuidora", "ano_referencia", "mes_referencia"]


def test_sketches_are_close(spark):
    exact = QUERIES["duration_stats"](spark, SF_DIR).first()
    sketch = QUERIES["duration_stats_sketch"](spark, SF_DIR).first()
    for name in ("mediana_minutos", "p95_minutos", "p99_minutos"):
        assert abs(exact[name] - sketch[name]) <= 60
    # the sketch has a relative error of 5 %, about one in ten agents at two deviations
    assert abs(QUERIES["distinct_agents_sketch"](spark, SF_DIR).first()["total"] - 10) <= 1
