"""The operators' queries against their SQL, over whole tables."""

import pytest

import __spark_entry__ as driver
from tests.comparing import connect, differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(driver.LLM_ORACLES))
def test_matches_oracle(name, spark):
    assert differences(driver.LLM_QUERIES[name](spark, SF_DIR), connect(SF_DIR), driver.LLM_ORACLES[name]) == []


def test_all_operators_are_registered():
    assert {name.split("_")[0] for name in driver.LLM_QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
