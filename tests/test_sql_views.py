"""The library tables as temporary views: reports written as Spark SQL text
give the same rows as the DataFrame jobs."""
import pytest

from conftest import rows
from folio.plans import aggregates, joins, subqueries, windows

SQL = {
    "q4_2": ("""SELECT CASE WHEN grouping(paid) = 1 THEN 'Overall Total' WHEN paid THEN 'Collected' ELSE 'Outstanding' END,
                       CAST(sum(fine_amount) AS DECIMAL(20,2)), count(*)
                FROM fines GROUP BY ROLLUP (paid)""", aggregates.q4_2_fines_summary),
    "q5_7": ("""SELECT concat(first_name, ' ', last_name), email, join_date, membership_type
                FROM members LEFT ANTI JOIN loans USING (member_id)""", joins.q5_7_members_never_borrowed),
    "q6_4": ("""WITH held AS (SELECT book_id, count(*) AS n FROM book_copies GROUP BY book_id),
                     lent AS (SELECT DISTINCT book_id FROM loans JOIN book_copies USING (copy_id))
                SELECT title, author_name, genre, coalesce(n, 0L), publication_year
                FROM books JOIN authors USING (author_id) LEFT JOIN held USING (book_id) LEFT ANTI JOIN lent USING (book_id)""",
             subqueries.q6_4_books_never_loaned),
    "q8_3": ("""WITH lent AS (SELECT copy_id, count(*) AS n FROM loans GROUP BY copy_id),
                     tally AS (SELECT book_id, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n
                               FROM book_copies LEFT JOIN lent USING (copy_id) GROUP BY book_id),
                     placed AS (SELECT genre, title, n, rank() OVER (PARTITION BY genre ORDER BY n DESC) AS place
                                FROM tally JOIN books USING (book_id))
                SELECT genre, title, n, CAST(place AS BIGINT) FROM placed WHERE place <= 3""",
             windows.q8_3_top3_per_genre),
}


@pytest.mark.parametrize("key", sorted(SQL))
def test_sql_on_views_matches_dataframe_job(spark, sf0001_lib, key):
    sql, job = SQL[key]
    sf0001_lib.register_views()
    assert sorted(rows(spark.sql(sql)), key=str) == sorted(rows(job(sf0001_lib)), key=str)
