"""Every registered query against its SQL, and the driver contract."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("absent", ["public_tokenizers", "zstandard", "patronflow.llm",
                                    "corpus_pipeline"])
def test_core_queries_do_without_the_text_operators(absent):
    """Whatever the text operators lack, the core queries are registered."""
    code = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
            "from checks.queries import QUERIES; assert set(e.queries()) == set(QUERIES)")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "initial_cohort", "since_first_order", "returning", "initial", "percent"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    wrong = difference(contract.queries()[name](spark, SF), connection,
                       contract.oracle_sql()[name])
    assert wrong is None, wrong


def test_registered_results_are_not_shifted(spark):
    weights = contract.queries()["BIZ19_fractional_weights"](spark, SF).collect()
    parts = ("voucher_weight", "first_weight", "last_weight", "rest_weight")
    assert any(r["rest_weight"] == 0.01 for r in weights)
    for row in weights:
        total = sum(row[p] for p in parts)
        assert abs(total - 1) < 1e-5 or total == 0, row
