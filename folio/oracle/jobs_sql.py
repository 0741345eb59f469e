"""DuckDB oracle SQL for the batch jobs (W1-W14).

Written the way a single SQL statement per output would compute it: windows
(ROW_NUMBER per book / member / copy) for the order-dependent parts, NOT IN /
NOT EXISTS as in the reference, so it checks the Spark plans independently.
"""

from folio.oracle.prefix import with_library
from folio.oracle.sqlfn import AS_OF, days, fine_days, fine_for_days

REQUEST_CTES = f"""
, checkout_requests AS (
  SELECT o_orderkey AS request_id,
         CASE WHEN o_orderkey % 35 = 0 THEN CAST(-1 AS BIGINT) ELSE o_custkey END AS member_id,
         (o_orderkey * 17) % (SELECT n FROM _n_parts) AS book_id,
         CASE WHEN o_orderkey % 45 = 0 THEN CAST(-1 AS BIGINT)
              ELSE ((o_orderkey * 17) % (SELECT n FROM _n_parts)) * 10 + 1 END AS copy_id,
         {AS_OF} AS loan_date,
         CASE WHEN o_orderkey % 2 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2001-07-10' END AS due_date
  FROM orders),
return_requests AS (SELECT o_orderkey AS request_id, o_orderkey AS loan_id FROM orders),
pay_requests AS (SELECT fine_id AS request_id, fine_id FROM fines WHERE fine_reason <> 'lost'),
_last_member AS (SELECT MAX(member_id) AS b FROM members),
batch_return_requests AS (
  SELECT (SELECT b FROM _last_member) - member_id AS request_id, member_id FROM members WHERE status <> 'active'
  UNION ALL SELECT (SELECT b FROM _last_member) + 1 + member_id, member_id FROM members WHERE status = 'suspended'),
_loan_base AS (SELECT COALESCE(MAX(loan_id), 0) AS b FROM loans),
_fine_base AS (SELECT COALESCE(MAX(fine_id), 0) AS b FROM fines),
active_copies AS (SELECT DISTINCT copy_id FROM loans WHERE status = 'active')
"""


def _q(body: str) -> str:
    return with_library(REQUEST_CTES + body)


def _new_loans_from(cte: str) -> str:
    return f"""
SELECT request_id, (SELECT b FROM _loan_base) + ROW_NUMBER() OVER (ORDER BY request_id) AS loan_id,
       member_id, copy_id, {AS_OF} AS loan_date, {AS_OF} + 14 AS due_date,
       CAST(NULL AS DATE) AS return_date, 'active' AS status
FROM {cte}"""


def _fines_from(cte: str, amount: str, order: str) -> str:
    return f"""
SELECT (SELECT b FROM _fine_base) + ROW_NUMBER() OVER (ORDER BY {order}) AS fine_id, loan_id,
       {amount} AS fine_amount, 'overdue' AS fine_reason, FALSE AS paid, CAST(NULL AS DATE) AS payment_date
FROM {cte}"""


W2 = """
, w2_staged AS (
  SELECT r.request_id, r.member_id, r.copy_id,
         CASE WHEN m.status IS NULL THEN 'Member not found.'
              WHEN m.status <> 'active' THEN 'Member not active.'
              WHEN c.copy_id IS NULL THEN 'Book copy not found.'
              WHEN a.copy_id IS NOT NULL THEN 'Book copy not available.' END AS early
  FROM checkout_requests r LEFT JOIN members m ON r.member_id = m.member_id
  LEFT JOIN book_copies c ON r.copy_id = c.copy_id LEFT JOIN active_copies a ON r.copy_id = a.copy_id),
w2_won AS (
  SELECT s.*, s.early IS NULL AND s.request_id =
           MIN(CASE WHEN s.early IS NULL THEN s.request_id END) OVER (PARTITION BY s.copy_id) AS won
  FROM w2_staged s)
"""

W3 = f"""
, w3 AS (
  SELECT r.request_id, r.loan_id, l.member_id, l.copy_id, l.loan_date, l.due_date,
         l.loan_id IS NOT NULL AND r.request_id = MIN(r.request_id) OVER (PARTITION BY r.loan_id) AS ok,
         {fine_days('l.due_date', AS_OF)} AS d
  FROM return_requests r LEFT JOIN (SELECT * FROM loans WHERE status = 'active') l ON r.loan_id = l.loan_id)
"""

W5 = """
, w5_checked AS (
  SELECT r.request_id, r.member_id, r.book_id, m.status
  FROM checkout_requests r LEFT JOIN members m ON r.member_id = m.member_id),
w5_free AS (
  SELECT c.book_id, c.copy_id, ROW_NUMBER() OVER (PARTITION BY c.book_id ORDER BY c.copy_id) AS slot
  FROM book_copies c WHERE c.copy_id NOT IN (SELECT copy_id FROM loans WHERE status = 'active')),
w5_req AS (
  SELECT request_id, member_id, book_id, ROW_NUMBER() OVER (PARTITION BY book_id ORDER BY request_id) AS slot
  FROM w5_checked WHERE status = 'active'),
w5_served AS (
  SELECT q.request_id, q.member_id, q.book_id, f.copy_id
  FROM w5_req q JOIN w5_free f ON q.book_id = f.book_id AND q.slot = f.slot)
"""

W6 = """
, w6_known AS (SELECT * FROM fines WHERE fine_id IN (SELECT fine_id FROM pay_requests))
"""

W7 = """
, w7_checked AS (
  SELECT r.request_id, r.member_id, r.copy_id, m.status, c.copy_id IS NOT NULL AS copy_known
  FROM checkout_requests r LEFT JOIN members m ON r.member_id = m.member_id
  LEFT JOIN book_copies c ON r.copy_id = c.copy_id),
w7_active AS (SELECT member_id, COUNT(*) AS a FROM loans WHERE status = 'active' GROUP BY member_id),
w7_elig AS (
  SELECT k.*, ROW_NUMBER() OVER (PARTITION BY k.member_id ORDER BY k.request_id) AS n
  FROM w7_checked k WHERE k.status = 'active' AND k.copy_known),
w7_dec AS (
  SELECT e.*, COALESCE(a.a, 0) + e.n <= 5 AS ok_commit
  FROM w7_elig e LEFT JOIN w7_active a ON e.member_id = a.member_id)
"""

W8 = f"""
, w8_first AS (SELECT member_id, MIN(request_id) AS request_id FROM batch_return_requests GROUP BY member_id),
w8_theirs AS (SELECT * FROM loans JOIN w8_first USING (member_id)),
w8_after AS (
  SELECT request_id, loan_id, member_id, due_date,
         CASE WHEN status = 'active' THEN {AS_OF} ELSE return_date END AS return_date,
         CASE WHEN status = 'active' THEN 'returned' ELSE status END AS status
  FROM w8_theirs),
w8_late AS (
  SELECT * FROM w8_after
  WHERE status = 'returned' AND return_date > due_date AND loan_id NOT IN (SELECT loan_id FROM fines))
"""

W9 = """
, w9_old AS (
  SELECT * FROM members WHERE status = 'active'
    AND member_id IN (SELECT l.member_id FROM fines f JOIN loans l ON f.loan_id = l.loan_id WHERE f.paid = FALSE))
"""

W10 = """
, w10 AS (
  SELECT r.request_id, r.member_id, r.copy_id, r.loan_date, r.due_date,
         COALESCE(m.status <> 'active', FALSE) AS bad
  FROM checkout_requests r LEFT JOIN members m ON r.member_id = m.member_id),
w11 AS (
  SELECT request_id, member_id, copy_id, loan_date, COALESCE(due_date, loan_date + 14) AS due_date
  FROM w10 WHERE NOT bad)
"""

W14 = """
, w14_busy AS (
  SELECT DISTINCT c.book_id FROM book_copies c JOIN loans l ON c.copy_id = l.copy_id WHERE l.status = 'active')
"""

_late_amount = fine_for_days(fine_days("l.due_date", AS_OF))

JOB_SQL = {
    "w1_fine_days": _q(f"""
SELECT loan_id, due_date, return_date, {fine_days('due_date', 'return_date')} AS fine_days
FROM loans WHERE return_date IS NOT NULL"""),
    "w2_results": _q(W2 + f"""
SELECT request_id, CASE WHEN won THEN {AS_OF} + 14 END AS due_date,
       CASE WHEN early IS NOT NULL THEN early
            WHEN won THEN 'Book checked out. Due on ' || CAST({AS_OF} + 14 AS VARCHAR)
            ELSE 'Book copy not available.' END AS message
FROM w2_won"""),
    "w2_new_loans": _q(W2 + _new_loans_from("w2_won WHERE won")),
    "w3_results": _q(W3 + f"""
SELECT request_id, loan_id,
       CASE WHEN ok AND d > 0 THEN {fine_for_days('d')} ELSE CAST(0 AS DECIMAL(10,2)) END AS fine_amount,
       CASE WHEN NOT ok THEN 'Loan not found or already returned.'
            WHEN d > 0 THEN 'Returned late by ' || CAST(d AS VARCHAR) || ' days. Fine $'
                            || CAST({fine_for_days('d')} AS VARCHAR)
            ELSE 'Returned on time. No fine.' END AS message
FROM w3"""),
    "w3_updated_loans": _q(W3 + f"""
SELECT loan_id, member_id, copy_id, loan_date, due_date, {AS_OF} AS return_date, 'returned' AS status
FROM w3 WHERE ok"""),
    "w3_new_fines": _q(W3 + _fines_from("w3 WHERE ok AND d > 0", fine_for_days("d"), "request_id")),
    "w5_results": _q(W5 + """
SELECT c.request_id, s.copy_id,
       CASE WHEN c.status IS NULL THEN 'Cannot create loan: unknown member'
            WHEN c.status <> 'active' THEN 'Cannot create loan: Member is not active'
            WHEN s.copy_id IS NULL THEN 'No available copy to checkout'
            ELSE 'Checkout successful' END AS message
FROM w5_checked c LEFT JOIN w5_served s ON c.request_id = s.request_id"""),
    "w5_new_loans": _q(W5 + _new_loans_from("w5_served")),
    "w5_audit": _q(W5 + f"""
SELECT 'loans' AS table_name, 'INSERT' AS action, loan_id AS record_id, 'SYSTEM' AS changed_by,
       'Book checked out' AS description
FROM ({_new_loans_from("w5_served")}) nl"""),
    "w6_updated_fines": _q(W6 + f"""
SELECT fine_id, loan_id, fine_amount, fine_reason, TRUE AS paid, {AS_OF} AS payment_date FROM w6_known"""),
    "w6_audit": _q(W6 + """
SELECT 'fines' AS table_name, 'UPDATE' AS action, r.fine_id AS record_id, 'SYSTEM' AS changed_by,
       'Fine paid: $' || CAST(f.fine_amount AS VARCHAR) AS description
FROM pay_requests r LEFT JOIN fines f ON r.fine_id = f.fine_id"""),
    "w6_reactivated": _q(W6 + """
SELECT m.member_id, m.first_name, m.last_name, m.email, m.phone, m.address, m.join_date,
       m.membership_type, 'active' AS status
FROM members m
WHERE m.status = 'suspended'
  AND m.member_id IN (SELECT l.member_id FROM w6_known k JOIN loans l ON k.loan_id = l.loan_id)
  AND NOT EXISTS (SELECT 1 FROM fines f2 JOIN loans l2 ON f2.loan_id = l2.loan_id
                  WHERE l2.member_id = m.member_id AND f2.paid = FALSE
                    AND f2.fine_id NOT IN (SELECT fine_id FROM pay_requests))"""),
    "w7_results": _q(W7 + """
SELECT k.request_id,
       CASE WHEN k.status IS NULL THEN 'Cannot create loan: unknown member'
            WHEN k.status <> 'active' THEN 'Cannot create loan: Member is not active'
            WHEN NOT k.copy_known THEN 'Cannot create loan: unknown book copy'
            WHEN d.ok_commit THEN 'Transaction committed successfully'
            ELSE 'Transaction rolled back: Member has too many active loans' END AS message
FROM w7_checked k LEFT JOIN w7_dec d ON k.request_id = d.request_id"""),
    "w7_new_loans": _q(W7 + _new_loans_from("w7_dec WHERE ok_commit")),
    "w8_updated_loans": _q(W8 + f"""
SELECT loan_id, member_id, copy_id, loan_date, due_date, {AS_OF} AS return_date, 'returned' AS status
FROM w8_theirs WHERE status = 'active'"""),
    "w8_new_fines": _q(W8 + _fines_from("w8_late l", fine_for_days(f"GREATEST(0, {days(AS_OF, 'l.due_date')})"),
                                        "request_id, loan_id")),
    "w8_audit": _q(W8 + """
SELECT 'loans' AS table_name, 'UPDATE' AS action, b.member_id AS record_id, 'SYSTEM' AS changed_by,
       'Batch return for member ' || CAST(b.member_id AS VARCHAR) || ': ' || CAST(COALESCE(n.c, 0) AS VARCHAR)
         || ' books' AS description
FROM batch_return_requests b
LEFT JOIN (SELECT request_id, COUNT(*) AS c FROM w8_late GROUP BY request_id) n ON b.request_id = n.request_id"""),
    "w8_loans_next": _q(W8 + f"""
SELECT loan_id, member_id, copy_id, loan_date, due_date,
       CASE WHEN status = 'active' AND member_id IN (SELECT member_id FROM w8_first) THEN {AS_OF} ELSE return_date END AS return_date,
       CASE WHEN status = 'active' AND member_id IN (SELECT member_id FROM w8_first) THEN 'returned' ELSE status END AS status
FROM loans"""),
    "x8_loans_changed": _q(W8 + f"""
, loans_next AS (
  SELECT loan_id, member_id, copy_id, loan_date, due_date,
         CASE WHEN status = 'active' AND member_id IN (SELECT member_id FROM w8_first) THEN {AS_OF} ELSE return_date END AS return_date,
         CASE WHEN status = 'active' AND member_id IN (SELECT member_id FROM w8_first) THEN 'returned' ELSE status END AS status
  FROM loans),
loans_then AS (SELECT loan_id, member_id, copy_id, loan_date, due_date, return_date, status FROM loans)
SELECT change, loan_id, member_id, copy_id, loan_date, due_date, return_date, status, count(*) AS times FROM (
  SELECT 'added' AS change, * FROM (SELECT * FROM loans_next EXCEPT ALL SELECT * FROM loans_then)
  UNION ALL SELECT 'removed', * FROM (SELECT * FROM loans_then EXCEPT ALL SELECT * FROM loans_next)) GROUP BY ALL"""),
    "w8_fines_next": _q(W8 + "SELECT fine_id, loan_id, fine_amount, fine_reason, paid, payment_date FROM fines UNION ALL " + _fines_from(
        "w8_late l", fine_for_days(f"GREATEST(0, {days(AS_OF, 'l.due_date')})"), "request_id, loan_id")),
    "w9_audit": _q(W9 + """
SELECT 'members' AS table_name, 'UPDATE' AS action, member_id AS record_id, 'SYSTEM' AS changed_by,
       'Member ' || first_name || ' ' || last_name || ' updated. Status: ' || status || ' -> ' || 'suspended'
         AS description
FROM w9_old"""),
    "w10_accepted": _q(W10 + """
SELECT request_id, member_id, copy_id, loan_date, due_date FROM w10 WHERE NOT bad"""),
    "w10_rejected": _q(W10 + """
SELECT request_id, member_id, copy_id, loan_date, due_date, 'Cannot create loan: Member is not active' AS reason
FROM w10 WHERE bad"""),
    "w11_new_loans": _q(W10 + "SELECT * FROM w11"),
    "w12_new_loan_keys": _q(W10 + """
SELECT w11.*, (SELECT b FROM _loan_base) + ROW_NUMBER() OVER (ORDER BY request_id) AS loan_id FROM w11"""),
    "w13_new_fines": _q(f"""
, w13 AS (SELECT * FROM loans WHERE status = 'active' AND {days(AS_OF, 'due_date')} > 0)
""" + _fines_from("w13", fine_for_days(days(AS_OF, "due_date")), "loan_id")),
    "w14_deletable": _q(W14 + """
SELECT book_id FROM books WHERE book_id NOT IN (SELECT book_id FROM w14_busy)"""),
    "w14_blocked": _q(W14 + """
SELECT book_id, 'Cannot delete book: Active loans exist' AS reason
FROM books WHERE book_id IN (SELECT book_id FROM w14_busy)"""),
}
