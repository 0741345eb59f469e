"""Row counts of FIXTURES.md §3 (sf0.001), worked out independently of this code."""
import pytest

from folio.plans.registry import REPORTS

EXPECTED = {
    "q3_4_overdue_loans": 510,
    "q3_5_recent_joiners": 10,
    "q3_6_poor_condition": 243,
    "q3_8_upcoming_events": 16,
    "q4_5_never_borrowed_copies": 226,
    "q5_7_members_never_borrowed": 9,
    "q5_8_same_address_pairs": 122,
    "q6_4_books_never_loaned": 20,
    "q6_5_attended_all": 9,
    "q8_5_next_event": 15,
}


@pytest.mark.parametrize("key,n", sorted(EXPECTED.items()))
def test_fixture_counts(sf0001_lib, key, n):
    assert REPORTS[key](sf0001_lib).count() == n
