"""The derived library tables (FIXTURES.md) and their declared constraints."""
import pytest

from conftest import rows
from folio.quality.rules import foreign_keys, row_rules, unique_keys

EXPECTED_ROWS = {"authors": 10, "members": 150, "lib_events": 30, "books": 200, "book_copies": 488,
                 "loans": 1500, "fines": 750, "event_registrations": 328}


@pytest.mark.parametrize("table,n", sorted(EXPECTED_ROWS.items()))
def test_row_counts(sf0001_lib, table, n):
    assert sf0001_lib.table(table).count() == n


def test_constraints_hold_on_derived_tables(sf0001_lib):
    tables = list(EXPECTED_ROWS)
    for df in (row_rules(sf0001_lib, tables), unique_keys(sf0001_lib, tables), foreign_keys(sf0001_lib)):
        bad = [r for r in rows(df) if r[3] != 0]
        assert not bad, bad


def test_fixture_has_the_edge_cases(sf0001_lib):
    from pyspark.sql import functions as F
    fines_per_loan = sf0001_lib.fines.groupBy("loan_id").count()
    assert fines_per_loan.filter(F.col("count") > 1).count() > 0          # fan-out in 4.6
    active = sf0001_lib.loans.filter(F.col("status") == "active").groupBy("copy_id").count()
    assert active.filter(F.col("count") > 1).count() > 0                  # fan-out in 5.4
    assert sf0001_lib.fines.filter(F.col("paid") & F.col("payment_date").isNull()).count() > 0  # NULL month
    titles = sf0001_lib.books.groupBy("title").count()
    assert titles.filter(F.col("count") > 1).count() > 0                  # title merge in 7.3
