"""DuckDB derivation of the library tables (FIXTURES.md §1), as a WITH prefix.

Every oracle query is ``LIBRARY_CTES + ", <more ctes> SELECT ..."`` or
``LIBRARY_CTES + " SELECT ..."``. The driver tables are pre-registered views.
"""

LIBRARY_CTES = """
WITH
_n_parts AS (SELECT count(*) AS n FROM part),
_n_supp AS (SELECT count(*) AS n FROM supplier),
authors AS (
  SELECT s.s_suppkey AS author_id, s.s_name AS author_name,
         1900 + s.s_suppkey % 90 AS birth_year, n.n_name AS country
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
members AS (
  SELECT c_custkey AS member_id, c_mktsegment AS first_name, c_name AS last_name,
         lower(c_name) || '@example.com' AS email,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '+1-' || CAST(c_custkey AS VARCHAR) END AS phone,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              ELSE 'ADDR-' || CAST(c_custkey - c_custkey % 3 AS VARCHAR) END AS address,
         DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INTEGER) AS join_date,
         CASE WHEN c_custkey % 10 < 5 THEN 'standard' WHEN c_custkey % 10 < 8 THEN 'premium'
              ELSE 'student' END AS membership_type,
         CASE WHEN c_custkey % 13 = 0 THEN 'suspended' WHEN c_custkey % 13 = 1 THEN 'expired'
              ELSE 'active' END AS status
  FROM customer
),
books AS (
  SELECT p_partkey AS book_id, p_name || ' ' || p_brand AS title,
         p_partkey % (SELECT n FROM _n_supp) AS author_id,
         '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isbn,
         1961 + p_size AS publication_year, p_type AS genre, 1 + p_size % 4 AS total_copies
  FROM part
),
_copy_numbers AS (
  SELECT book_id, CAST(unnest(range(1, total_copies + 1)) AS INTEGER) AS copy_number FROM books
),
book_copies AS (
  SELECT book_id * 10 + copy_number AS copy_id, book_id, copy_number,
         CASE (book_id + copy_number) % 4 WHEN 0 THEN 'excellent' WHEN 1 THEN 'good'
              WHEN 2 THEN 'fair' ELSE 'poor' END AS condition_status,
         DATE '1994-01-01' + CAST((book_id * 7 + copy_number) % 365 AS INTEGER) AS acquisition_date
  FROM _copy_numbers
),
_lent AS (
  SELECT o.*, CASE WHEN ((o_orderkey * 31) % (SELECT n FROM _n_parts)) % 10 = 9
                   THEN (o_orderkey * 31) % (SELECT n FROM _n_parts) - 1
                   ELSE (o_orderkey * 31) % (SELECT n FROM _n_parts) END AS lent_book
  FROM orders o
),
loans AS (
  SELECT o_orderkey AS loan_id,
         o_custkey + CASE WHEN o_custkey = 0 THEN 1 WHEN o_custkey % 17 = 0 THEN -1 ELSE 0 END AS member_id,
         lent_book * 10 + 1 + o_orderkey % b.total_copies AS copy_id,
         CAST(o_orderdate AS DATE) AS loan_date,
         CAST(o_orderdate AS DATE) + 14 AS due_date,
         CASE WHEN o_orderstatus = 'F'
              THEN CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 25 AS INTEGER) END AS return_date,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'returned' WHEN 'P' THEN 'lost' END AS status
  FROM _lent JOIN books b ON b.book_id = _lent.lent_book
),
fines AS (
  SELECT loan_id * 2 AS fine_id, loan_id,
         CAST((loan_id * 53 % 12000) * 0.01 AS DECIMAL(10,2)) AS fine_amount,
         CASE loan_id % 9 WHEN 0 THEN 'overdue' WHEN 3 THEN 'damage' ELSE 'lost' END AS fine_reason,
         loan_id % 2 = 0 AS paid,
         CASE WHEN loan_id % 2 = 0 AND loan_id % 50 <> 0 THEN loan_date + 30 END AS payment_date
  FROM loans WHERE loan_id % 3 = 0
  UNION ALL
  SELECT loan_id * 2 + 1 AS fine_id, loan_id,
         CAST((loan_id * 53 % 12000) * 0.01 AS DECIMAL(10,2)) AS fine_amount,
         CASE loan_id % 9 WHEN 0 THEN 'overdue' WHEN 3 THEN 'damage' ELSE 'lost' END AS fine_reason,
         loan_id % 2 = 1 AS paid,
         CASE WHEN loan_id % 2 = 1 AND loan_id % 50 <> 0 THEN loan_date + 30 END AS payment_date
  FROM loans WHERE loan_id % 12 IN (0, 3)
),
_clicks AS (
  SELECT CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
                         WHEN 'signup' THEN 4 WHEN 'error' THEN 5 ELSE 0 END AS ti,
         event_type AS click_type,
         CAST(date_trunc('week', ts) AS DATE) AS wk,
         CAST(date_diff('day', DATE '2024-01-01', CAST(date_trunc('week', ts) AS DATE)) AS BIGINT) AS wd,
         user_id, ts
  FROM events
),
lib_events AS (
  SELECT wd * 10 + ti AS event_id,
         click_type || ' ' || CAST(wk AS VARCHAR) AS event_name,
         wk + ti AS event_date,
         CASE ti WHEN 1 THEN 'book_club' WHEN 2 THEN 'workshop' WHEN 3 THEN 'reading_program'
                 WHEN 4 THEN 'author_visit' WHEN 5 THEN 'workshop' WHEN 6 THEN 'workshop' ELSE click_type END AS event_type,
         CASE WHEN ti = 4 THEN NULL ELSE 50 + ti * 20 END AS max_attendees
  FROM (SELECT ti, click_type, wk, wd FROM _clicks UNION SELECT 6, 'open day', wk, wd FROM _clicks)
),
event_registrations AS (
  SELECT (wd * 10 + ti) * 1000000000000 + user_id AS registration_id, wd * 10 + ti AS event_id,
         user_id AS member_id, CAST(min(ts) AS DATE) AS registration_date
  FROM _clicks
  GROUP BY wd, ti, user_id
)
"""


def with_library(sql: str) -> str:
    """Prefix a query body with the library CTEs.

    ``sql`` is either a plain SELECT, or starts with ``, name AS (...)`` to add
    more CTEs after the library ones.
    """
    body = sql.strip()
    return LIBRARY_CTES + ("\n" if body.startswith(",") else "\n") + body
