"""Reports on a tiny hand-made library with hand-worked answers.

The fixture has: a loan with two fines (fan-out in 4.6), a copy with two
active loans (fan-out in 5.4), two books sharing a title (merge in 7.3), a
paid fine without payment date (NULL month in 6.6, NULL-first in 8.2), a
book without copies, a member without loans and without address."""
import datetime as dt
import random
from decimal import Decimal

import pytest

from conftest import rows
from folio.plans import aggregates, joins, setops, subqueries, windows
from folio.sources.library import Library

D = dt.date


@pytest.fixture(scope="module")
def lib(spark):
    return Library.from_rows(
        spark,
        authors=[(1, "Ann", 1950, "X"), (2, "Bob", 1960, "Y")],
        members=[(1, "Ada", "Lane", "a@x", None, "A1", D(2001, 5, 1), "standard", "active"),
                 (2, "Ben", "Moss", "b@x", None, "A1", D(2000, 1, 1), "premium", "active"),
                 (3, "Cy", "Nash", "c@x", None, "A1", D(2001, 6, 1), "student", "suspended"),
                 (4, "Di", "Ode", "d@x", None, None, D(1999, 1, 1), "standard", "active")],
        books=[(10, "T1", 1, "i10", 2001, "G1", 2), (20, "T1", 2, "i20", 1999, "G1", 1),
               (30, "T3", 1, "i30", 2005, "G2", 1), (40, "T4", 2, "i40", 1990, "G2", 1)],
        book_copies=[(101, 10, 1, "good", None), (102, 10, 2, "poor", None),
                     (201, 20, 1, "fair", None), (301, 30, 1, "good", None)],
        loans=[(1, 1, 101, D(2001, 6, 1), D(2001, 6, 15), None, "active"),
               (2, 1, 101, D(2001, 6, 2), D(2001, 6, 16), None, "active"),
               (3, 2, 201, D(2001, 5, 1), D(2001, 5, 15), D(2001, 5, 20), "returned"),
               (4, 2, 301, D(2001, 6, 20), D(2001, 7, 4), None, "active"),
               (5, 3, 102, D(2001, 4, 1), D(2001, 4, 15), D(2001, 4, 10), "returned")],
        fines=[(1, 1, Decimal("5.00"), "overdue", False, None),
               (2, 1, Decimal("2.50"), "damage", False, None),
               (3, 3, Decimal("1.25"), "overdue", True, D(2001, 5, 21)),
               (4, 5, Decimal("3.00"), "lost", True, None)],
    )


def test_4_1_share(lib):
    assert sorted(rows(aggregates.q4_1_membership_share(lib))) == [
        ("premium", 1, 25.0), ("standard", 2, 50.0), ("student", 1, 25.0)]


def test_4_2_summary(lib):
    assert sorted(rows(aggregates.q4_2_fines_summary(lib))) == [
        ("Collected", Decimal("4.25"), 2), ("Outstanding", Decimal("7.50"), 2),
        ("Overall Total", Decimal("11.75"), 4)]


def test_4_6_keeps_fine_fan_out(lib):
    assert rows(aggregates.q4_6_member_activity(lib)) == [
        ("Ada Lane", 3, 3, Decimal("7.50")), ("Ben Moss", 2, 1, Decimal("0.00")),
        ("Cy Nash", 1, 0, Decimal("0.00"))]


def test_5_4_counts_copies_per_active_loan(lib):
    assert sorted(rows(joins.q5_4_availability(lib))) == [
        ("T1", "Ann", 3, 2, 1), ("T1", "Bob", 1, 0, 1), ("T3", "Ann", 1, 1, 0), ("T4", "Bob", 0, 0, 0)]


def test_5_7_and_5_8(lib):
    assert rows(joins.q5_7_members_never_borrowed(lib), "member_name") == [("Di Ode",)]
    assert sorted(rows(joins.q5_8_same_address_pairs(lib))) == [
        ("Ada Lane", "Ben Moss", "A1"), ("Ada Lane", "Cy Nash", "A1"), ("Ben Moss", "Cy Nash", "A1")]


def test_6_6_null_month_stays_a_row(lib):
    assert rows(subqueries.q6_6_monthly_revenue(lib)) == [
        ("2001-06", Decimal("0.00"), 100, Decimal("100.00")),
        ("2001-05", Decimal("1.25"), 100, Decimal("101.25")),
        ("2000-01", Decimal("0.00"), 100, Decimal("100.00")),
        ("1999-01", Decimal("0.00"), 100, Decimal("100.00")),
        (None, Decimal("3.00"), 0, Decimal("3.00"))]


def test_7_3_merges_equal_titles(lib):
    assert sorted(rows(setops.q7_3_available_vs_loaned(lib))) == [
        ("T1", "Available", 2), ("T1", "On Loan", 2), ("T3", "On Loan", 1)]


def test_8_1_ranks(lib):
    assert rows(windows.q8_1_member_ranks(lib)) == [
        (1, 1, 1, "Ada Lane", 2), (2, 1, 1, "Ben Moss", 2), (3, 3, 2, "Cy Nash", 1)]


def test_8_2_running_total_null_dates_first(lib):
    assert rows(windows.q8_2_running_fines(lib)) == [
        (None, Decimal("3.00"), Decimal("3.00")), (D(2001, 5, 21), Decimal("1.25"), Decimal("4.25"))]


def test_8_7_percentile(lib):
    assert sorted(rows(windows.q8_7_fine_percentile(lib))) == [
        ("Ada Lane", Decimal("2.50"), 0.0), ("Ada Lane", Decimal("5.00"), 100.0)]


def test_6_8_recommendations(lib):
    assert rows(subqueries.q6_8_recommendations(lib)) == [
        ("Ada Lane", "G1", "T1"), ("Ben Moss", "G1", "T1"), ("Cy Nash", "G1", "T1")]


@pytest.mark.parametrize("seed,k", [(1, 5), (2, 5), (3, 40)])
def test_6_8_matches_brute_force(spark, seed, k):
    """Candidate generation (ranks after read books) equals pairing every
    member with every book of the favourite genre."""
    rnd = random.Random(seed)
    genres = ["A", "B", "C"]
    books = [(b, f"t{b}", 1 + b % 3, f"i{b}", 2000, rnd.choice(genres), 1) for b in range(1, 120)]
    copies = [(b * 10 + 1, b, 1, "good", None) for b, *_ in books]
    members = [(m, f"f{m}", f"l{m}", f"e{m}", None, None, D(2000, 1, 1), "standard", "active") for m in range(1, 40)]
    loans = []
    for lid in range(1, 700):
        m = rnd.choice([1, 1, 1] + list(range(1, 40)))           # member 1 reads a lot
        b = rnd.randint(1, 60) if m == 1 else rnd.randint(1, 119)
        loans.append((lid, m, b * 10 + 1, D(2001, 1, 1), D(2001, 1, 15), None, "returned"))
    lib = Library.from_rows(spark, authors=[(1, "a", None, None), (2, "b", None, None), (3, "c", None, None)],
                            books=books, book_copies=copies, members=members, loans=loans)
    genre_of = {b: g for b, _, _, _, _, g, _ in books}
    read, counts = {}, {}
    for _, m, c, *_ in loans:
        b = c // 10
        read.setdefault(m, set()).add(b)
        counts[(m, genre_of[b])] = counts.get((m, genre_of[b]), 0) + 1
    fav = {}
    for (m, g), n in counts.items():
        if m not in fav or (-n, g) < (-counts[(m, fav[m])], fav[m]):
            fav[m] = g
    pairs = sorted((m, b) for m in fav for b in range(1, 120) if genre_of[b] == fav[m] and b not in read[m])[:k]
    want = [(f"f{m} l{m}", fav[m], f"t{b}") for m, b in pairs]
    assert rows(subqueries.q6_8_recommendations(lib, k=k)) == want
