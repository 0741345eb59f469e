"""DuckDB SQL of the reports over time, by the definitions: range joins over all pairs, sums over all earlier steps."""

from folio.oracle.sqlfn import AS_OF

_PERIODS = f"""
, periods AS (
  SELECT loan_id, copy_id, loan_date AS first_day,
         greatest(CASE WHEN status = 'active' THEN greatest({AS_OF}, loan_date) ELSE coalesce(return_date, due_date) END, loan_date + 1) AS end_day
  FROM loans)"""

TEMPORAL_SQL = {
    "x1_payment_after_loan": """
, paid AS (SELECT f.fine_id, f.loan_id, l.member_id, f.payment_date FROM fines f JOIN loans l USING (loan_id) WHERE f.paid),
earlier AS (
  SELECT p.fine_id, o.loan_id, o.loan_date, o.status FROM paid p JOIN loans o ON o.member_id = p.member_id AND o.loan_date < p.payment_date
  QUALIFY row_number() OVER (PARTITION BY p.fine_id ORDER BY o.loan_date DESC, o.loan_id DESC) = 1)
SELECT p.fine_id, p.loan_id, p.member_id, p.payment_date, e.loan_id AS latest_loan_id, e.loan_date AS latest_loan_date,
       e.status AS latest_status, CAST(p.payment_date - e.loan_date AS INTEGER) AS days_after
FROM paid p LEFT JOIN earlier e USING (fine_id)""",
    "x2_copies_lent_twice": _PERIODS + """
SELECT a.copy_id, a.loan_id AS first_loan_id, b.loan_id AS second_loan_id, b.first_day AS overlap_from,
       CAST(least(a.end_day, b.end_day) - b.first_day AS INTEGER) AS overlap_days
FROM periods a JOIN periods b ON a.copy_id = b.copy_id AND (a.first_day, a.loan_id) < (b.first_day, b.loan_id) AND b.first_day < a.end_day""",
    "x3_peak_open_loans": _PERIODS + """
, lasting AS (SELECT genre, first_day, end_day FROM periods JOIN book_copies USING (copy_id) JOIN books USING (book_id)),
steps AS (SELECT genre, first_day AS moment, 1 AS step FROM lasting UNION ALL SELECT genre, end_day, -1 FROM lasting),
levels AS (SELECT genre, moment, sum(sum(step)) OVER (PARTITION BY genre ORDER BY moment) AS n FROM steps GROUP BY genre, moment)
SELECT genre, CAST(n AS BIGINT) AS peak_open, moment AS reached FROM levels
QUALIFY row_number() OVER (PARTITION BY genre ORDER BY n DESC, moment) = 1""",
}

SESSIONS_SQL = {
    "x4_click_sessions": """
WITH told AS (
  SELECT user_id, event_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
  FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM told)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS clicks FROM numbered GROUP BY user_id, n""",
}

SUMMARY_SQL = {
    # Estimates are held to their bounds in the query; here every one keeps it.
    "x5_quarter_sketches": """
, lent AS (SELECT CAST(date_trunc('quarter', loan_date) AS DATE) AS quarter, count(DISTINCT member_id) AS borrowers FROM loans GROUP BY 1),
paid AS (
  SELECT CAST(date_trunc('quarter', payment_date) AS DATE) AS quarter, count(*) AS fines, quantile_cont(CAST(fine_amount * 100 AS DOUBLE), 0.5) AS median_cents
  FROM fines WHERE paid AND payment_date IS NOT NULL GROUP BY 1)
SELECT quarter, borrowers, CASE WHEN borrowers IS NOT NULL THEN true END AS borrowers_close, fines, median_cents,
       CASE WHEN fines IS NOT NULL THEN true END AS median_close
FROM lent FULL JOIN paid USING (quarter)""",
    "x6_reading_circle": """
SELECT member_id, CAST(min(steps) AS INTEGER) AS steps FROM (
  WITH RECURSIVE lent AS (SELECT DISTINCT member_id, book_id FROM loans JOIN book_copies USING (copy_id)),
  circle AS (
    SELECT member_id, 0 AS steps FROM loans WHERE loan_date = (SELECT min(loan_date) FROM loans)
    UNION
    SELECT b.member_id, steps + 1 FROM circle c JOIN lent a ON a.member_id = c.member_id JOIN lent b ON b.book_id = a.book_id WHERE steps < 12)
  SELECT * FROM circle) GROUP BY member_id""",
    "x7_lending_cube": """
SELECT genre, month, membership_type, CAST(grouping(genre, month, membership_type) AS INTEGER) AS level, count(*) AS loans, count(DISTINCT member_id) AS members
FROM (SELECT genre, CAST(date_trunc('month', loan_date) AS DATE) AS month, membership_type, member_id
      FROM loans JOIN book_copies USING (copy_id) JOIN books USING (book_id) JOIN members USING (member_id))
GROUP BY CUBE (genre, month, membership_type)""",
}
