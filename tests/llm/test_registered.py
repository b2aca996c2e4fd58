"""The operators' queries are registered, and equal to their SQL where it exists."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck
from patronflow.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = [n for n in contract.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    wrong = difference(contract.queries()[name](spark, SF), duck(SF), contract.oracle_sql()[name])
    assert wrong is None, wrong
