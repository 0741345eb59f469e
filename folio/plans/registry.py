"""Catalogue of the reports: driver key → function of a Library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folio.plans import aggregates, basic, joins, setops, subqueries, summaries, temporal, tuned, windows
from folio.plans.member_report import member_report
from folio.sources.catalog import library_for
from folio.sources.library import Library

ReportFn = Callable[[Library], DataFrame]

REPORTS: dict[str, ReportFn] = {
    "q3_1_active_members": basic.q3_1_active_members,
    "q3_2_books_since_2001": basic.q3_2_books_since_2001,
    "q3_3_genre_search": basic.q3_3_genre_search,
    "q3_4_overdue_loans": basic.q3_4_overdue_loans,
    "q3_5_recent_joiners": basic.q3_5_recent_joiners,
    "q3_6_poor_condition": basic.q3_6_poor_condition,
    "q3_7_top_unpaid_fines": basic.q3_7_top_unpaid_fines,
    "q3_8_upcoming_events": basic.q3_8_upcoming_events,
    "q4_1_membership_share": aggregates.q4_1_membership_share,
    "q4_2_fines_summary": aggregates.q4_2_fines_summary,
    "q4_3_top_genres": aggregates.q4_3_top_genres,
    "q4_4_avg_loan_days": aggregates.q4_4_avg_loan_days,
    "q4_5_never_borrowed_copies": aggregates.q4_5_never_borrowed_copies,
    "q4_6_member_activity": aggregates.q4_6_member_activity,
    "q4_7_monthly_loans": aggregates.q4_7_monthly_loans,
    "q4_8_event_capacity": aggregates.q4_8_event_capacity,
    "q5_1_loan_history": joins.q5_1_loan_history,
    "q5_2_on_loan": joins.q5_2_on_loan,
    "q5_3_members_unpaid": joins.q5_3_members_unpaid,
    "q5_4_availability": joins.q5_4_availability,
    "q5_5_attendance": joins.q5_5_attendance,
    "q5_6_author_popularity": joins.q5_6_author_popularity,
    "q5_7_members_never_borrowed": joins.q5_7_members_never_borrowed,
    "q5_8_same_address_pairs": joins.q5_8_same_address_pairs,
    "q6_1_above_avg_fines": subqueries.q6_1_above_avg_fines,
    "q6_2_popular_books": subqueries.q6_2_popular_books,
    "q6_3_borrowing_summary": subqueries.q6_3_borrowing_summary,
    "q6_4_books_never_loaned": subqueries.q6_4_books_never_loaned,
    "q6_5_attended_all": subqueries.q6_5_attended_all,
    "q6_6_monthly_revenue": subqueries.q6_6_monthly_revenue,
    "q6_7_last_loan": subqueries.q6_7_last_loan,
    "q6_8_recommendations": subqueries.q6_8_recommendations,
    "q7_1_all_people": setops.q7_1_all_people,
    "q7_2_activity_log": setops.q7_2_activity_log,
    "q7_3_available_vs_loaned": setops.q7_3_available_vs_loaned,
    "q7_4_members_with_issues": setops.q7_4_members_with_issues,
    "q7_5_popular_unpopular": setops.q7_5_popular_unpopular,
    "q8_1_member_ranks": windows.q8_1_member_ranks,
    "q8_2_running_fines": windows.q8_2_running_fines,
    "q8_3_top3_per_genre": windows.q8_3_top3_per_genre,
    "q8_4_monthly_change": windows.q8_4_monthly_change,
    "q8_5_next_event": windows.q8_5_next_event,
    "q8_6_moving_avg": windows.q8_6_moving_avg,
    "q8_7_fine_percentile": windows.q8_7_fine_percentile,
    "q8_8_loan_gaps": windows.q8_8_loan_gaps,
    "q11_1_loans_per_book": tuned.q11_1_loans_per_book,
    "q11_3_active_per_member": tuned.q11_3_active_per_member,
    "q11_4_loans_and_active": tuned.q11_4_loans_and_active,
    "q11_5_overdue_rows": tuned.q11_5_overdue_rows,
}


def _member_report_part(part: str) -> ReportFn:
    def run(lib: Library) -> DataFrame:
        # The batch form of GenerateMemberReport, for every member.
        return member_report(lib, lib.members.select("member_id"))[part]
    run.__name__ = f"member_report_{part}"
    return run


REPORTS.update({
    "x1_payment_after_loan": temporal.x1_payment_after_loan,
    "x2_copies_lent_twice": temporal.x2_copies_lent_twice,
    "x3_peak_open_loans": temporal.x3_peak_open_loans,
    "x5_quarter_sketches": summaries.x5_quarter_sketches,
    "x6_reading_circle": summaries.x6_reading_circle,
    "x7_lending_cube": summaries.x7_lending_cube,
})

REPORTS.update({
    "q9_4a_member_profile": _member_report_part("profile"),
    "q9_4b_current_loans": _member_report_part("current_loans"),
    "q9_4c_unpaid_total": _member_report_part("unpaid_total"),
    "q9_4d_upcoming_events": _member_report_part("upcoming_events"),
})


def on_driver_tables(fn: ReportFn) -> Callable[[SparkSession, str], DataFrame]:
    """Adapt a Library function to the (spark, sf_dir) signature."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(library_for(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run
