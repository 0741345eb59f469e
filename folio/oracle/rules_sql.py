"""The declared constraints as DuckDB SQL, one arm a rule. ``{p}`` is the prefix of the table names:
none for the clean tables, ``dirty_`` for the broken ones."""

ROW_RULE_SQL = """
SELECT 'not_null' AS rule, 'authors' AS table_name, 'author_id' AS check_name, count(*) FILTER (author_id IS NULL) AS violations FROM {p}authors
UNION ALL SELECT 'not_null' AS rule, 'authors' AS table_name, 'author_name' AS check_name, count(*) FILTER (author_name IS NULL) AS violations FROM {p}authors
UNION ALL SELECT 'length' AS rule, 'authors' AS table_name, 'author_name' AS check_name, count(*) FILTER (length(author_name) > 100) AS violations FROM {p}authors
UNION ALL SELECT 'length' AS rule, 'authors' AS table_name, 'country' AS check_name, count(*) FILTER (length(country) > 50) AS violations FROM {p}authors
UNION ALL SELECT 'not_null' AS rule, 'members' AS table_name, 'member_id' AS check_name, count(*) FILTER (member_id IS NULL) AS violations FROM {p}members
UNION ALL SELECT 'not_null' AS rule, 'members' AS table_name, 'first_name' AS check_name, count(*) FILTER (first_name IS NULL) AS violations FROM {p}members
UNION ALL SELECT 'not_null' AS rule, 'members' AS table_name, 'last_name' AS check_name, count(*) FILTER (last_name IS NULL) AS violations FROM {p}members
UNION ALL SELECT 'not_null' AS rule, 'members' AS table_name, 'email' AS check_name, count(*) FILTER (email IS NULL) AS violations FROM {p}members
UNION ALL SELECT 'domain' AS rule, 'members' AS table_name, 'membership_type' AS check_name, count(*) FILTER (membership_type NOT IN ('premium', 'standard', 'student')) AS violations FROM {p}members
UNION ALL SELECT 'domain' AS rule, 'members' AS table_name, 'status' AS check_name, count(*) FILTER (status NOT IN ('active', 'expired', 'suspended')) AS violations FROM {p}members
UNION ALL SELECT 'length' AS rule, 'members' AS table_name, 'first_name' AS check_name, count(*) FILTER (length(first_name) > 50) AS violations FROM {p}members
UNION ALL SELECT 'length' AS rule, 'members' AS table_name, 'last_name' AS check_name, count(*) FILTER (length(last_name) > 50) AS violations FROM {p}members
UNION ALL SELECT 'length' AS rule, 'members' AS table_name, 'email' AS check_name, count(*) FILTER (length(email) > 100) AS violations FROM {p}members
UNION ALL SELECT 'length' AS rule, 'members' AS table_name, 'phone' AS check_name, count(*) FILTER (length(phone) > 20) AS violations FROM {p}members
UNION ALL SELECT 'length' AS rule, 'members' AS table_name, 'address' AS check_name, count(*) FILTER (length(address) > 200) AS violations FROM {p}members
UNION ALL SELECT 'not_null' AS rule, 'lib_events' AS table_name, 'event_id' AS check_name, count(*) FILTER (event_id IS NULL) AS violations FROM {p}lib_events
UNION ALL SELECT 'not_null' AS rule, 'lib_events' AS table_name, 'event_name' AS check_name, count(*) FILTER (event_name IS NULL) AS violations FROM {p}lib_events
UNION ALL SELECT 'not_null' AS rule, 'lib_events' AS table_name, 'event_date' AS check_name, count(*) FILTER (event_date IS NULL) AS violations FROM {p}lib_events
UNION ALL SELECT 'not_null' AS rule, 'lib_events' AS table_name, 'event_type' AS check_name, count(*) FILTER (event_type IS NULL) AS violations FROM {p}lib_events
UNION ALL SELECT 'domain' AS rule, 'lib_events' AS table_name, 'event_type' AS check_name, count(*) FILTER (event_type NOT IN ('author_visit', 'book_club', 'reading_program', 'workshop')) AS violations FROM {p}lib_events
UNION ALL SELECT 'length' AS rule, 'lib_events' AS table_name, 'event_name' AS check_name, count(*) FILTER (length(event_name) > 100) AS violations FROM {p}lib_events
UNION ALL SELECT 'not_null' AS rule, 'books' AS table_name, 'book_id' AS check_name, count(*) FILTER (book_id IS NULL) AS violations FROM {p}books
UNION ALL SELECT 'not_null' AS rule, 'books' AS table_name, 'title' AS check_name, count(*) FILTER (title IS NULL) AS violations FROM {p}books
UNION ALL SELECT 'not_null' AS rule, 'books' AS table_name, 'author_id' AS check_name, count(*) FILTER (author_id IS NULL) AS violations FROM {p}books
UNION ALL SELECT 'not_null' AS rule, 'books' AS table_name, 'isbn' AS check_name, count(*) FILTER (isbn IS NULL) AS violations FROM {p}books
UNION ALL SELECT 'not_null' AS rule, 'books' AS table_name, 'genre' AS check_name, count(*) FILTER (genre IS NULL) AS violations FROM {p}books
UNION ALL SELECT 'check' AS rule, 'books' AS table_name, 'total_copies > 0' AS check_name, count(*) FILTER (total_copies < 1) AS violations FROM {p}books
UNION ALL SELECT 'length' AS rule, 'books' AS table_name, 'title' AS check_name, count(*) FILTER (length(title) > 200) AS violations FROM {p}books
UNION ALL SELECT 'length' AS rule, 'books' AS table_name, 'isbn' AS check_name, count(*) FILTER (length(isbn) > 20) AS violations FROM {p}books
UNION ALL SELECT 'length' AS rule, 'books' AS table_name, 'genre' AS check_name, count(*) FILTER (length(genre) > 50) AS violations FROM {p}books
UNION ALL SELECT 'not_null' AS rule, 'book_copies' AS table_name, 'copy_id' AS check_name, count(*) FILTER (copy_id IS NULL) AS violations FROM {p}book_copies
UNION ALL SELECT 'not_null' AS rule, 'book_copies' AS table_name, 'book_id' AS check_name, count(*) FILTER (book_id IS NULL) AS violations FROM {p}book_copies
UNION ALL SELECT 'not_null' AS rule, 'book_copies' AS table_name, 'copy_number' AS check_name, count(*) FILTER (copy_number IS NULL) AS violations FROM {p}book_copies
UNION ALL SELECT 'domain' AS rule, 'book_copies' AS table_name, 'condition_status' AS check_name, count(*) FILTER (condition_status NOT IN ('excellent', 'fair', 'good', 'poor')) AS violations FROM {p}book_copies
UNION ALL SELECT 'not_null' AS rule, 'loans' AS table_name, 'loan_id' AS check_name, count(*) FILTER (loan_id IS NULL) AS violations FROM {p}loans
UNION ALL SELECT 'not_null' AS rule, 'loans' AS table_name, 'member_id' AS check_name, count(*) FILTER (member_id IS NULL) AS violations FROM {p}loans
UNION ALL SELECT 'not_null' AS rule, 'loans' AS table_name, 'copy_id' AS check_name, count(*) FILTER (copy_id IS NULL) AS violations FROM {p}loans
UNION ALL SELECT 'not_null' AS rule, 'loans' AS table_name, 'loan_date' AS check_name, count(*) FILTER (loan_date IS NULL) AS violations FROM {p}loans
UNION ALL SELECT 'not_null' AS rule, 'loans' AS table_name, 'due_date' AS check_name, count(*) FILTER (due_date IS NULL) AS violations FROM {p}loans
UNION ALL SELECT 'domain' AS rule, 'loans' AS table_name, 'status' AS check_name, count(*) FILTER (status NOT IN ('active', 'lost', 'returned')) AS violations FROM {p}loans
UNION ALL SELECT 'not_null' AS rule, 'fines' AS table_name, 'fine_id' AS check_name, count(*) FILTER (fine_id IS NULL) AS violations FROM {p}fines
UNION ALL SELECT 'not_null' AS rule, 'fines' AS table_name, 'loan_id' AS check_name, count(*) FILTER (loan_id IS NULL) AS violations FROM {p}fines
UNION ALL SELECT 'not_null' AS rule, 'fines' AS table_name, 'fine_amount' AS check_name, count(*) FILTER (fine_amount IS NULL) AS violations FROM {p}fines
UNION ALL SELECT 'not_null' AS rule, 'fines' AS table_name, 'fine_reason' AS check_name, count(*) FILTER (fine_reason IS NULL) AS violations FROM {p}fines
UNION ALL SELECT 'domain' AS rule, 'fines' AS table_name, 'fine_reason' AS check_name, count(*) FILTER (fine_reason NOT IN ('damage', 'lost', 'overdue')) AS violations FROM {p}fines
UNION ALL SELECT 'check' AS rule, 'fines' AS table_name, 'fine_amount >= 0' AS check_name, count(*) FILTER (fine_amount < 0) AS violations FROM {p}fines
UNION ALL SELECT 'not_null' AS rule, 'event_registrations' AS table_name, 'registration_id' AS check_name, count(*) FILTER (registration_id IS NULL) AS violations FROM {p}event_registrations
UNION ALL SELECT 'not_null' AS rule, 'event_registrations' AS table_name, 'event_id' AS check_name, count(*) FILTER (event_id IS NULL) AS violations FROM {p}event_registrations
UNION ALL SELECT 'not_null' AS rule, 'event_registrations' AS table_name, 'member_id' AS check_name, count(*) FILTER (member_id IS NULL) AS violations FROM {p}event_registrations
UNION ALL SELECT 'not_null' AS rule, 'audit_log' AS table_name, 'log_id' AS check_name, count(*) FILTER (log_id IS NULL) AS violations FROM {p}audit_log
UNION ALL SELECT 'domain' AS rule, 'audit_log' AS table_name, 'action' AS check_name, count(*) FILTER (action NOT IN ('DELETE', 'INSERT', 'UPDATE')) AS violations FROM {p}audit_log
UNION ALL SELECT 'length' AS rule, 'audit_log' AS table_name, 'table_name' AS check_name, count(*) FILTER (length(table_name) > 50) AS violations FROM {p}audit_log
UNION ALL SELECT 'length' AS rule, 'audit_log' AS table_name, 'changed_by' AS check_name, count(*) FILTER (length(changed_by) > 50) AS violations FROM {p}audit_log"""

UNIQUE_SQL = """
SELECT 'unique' AS rule, 'authors' AS table_name, 'author_id' AS check_name, count(DISTINCT author_id) AS violations FROM (SELECT author_id, count(*) OVER (PARTITION BY author_id) AS times FROM {p}authors WHERE author_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'members' AS table_name, 'member_id' AS check_name, count(DISTINCT member_id) AS violations FROM (SELECT member_id, count(*) OVER (PARTITION BY member_id) AS times FROM {p}members WHERE member_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'members' AS table_name, 'email' AS check_name, count(DISTINCT email) AS violations FROM (SELECT email, count(*) OVER (PARTITION BY email) AS times FROM {p}members WHERE email IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'lib_events' AS table_name, 'event_id' AS check_name, count(DISTINCT event_id) AS violations FROM (SELECT event_id, count(*) OVER (PARTITION BY event_id) AS times FROM {p}lib_events WHERE event_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'audit_log' AS table_name, 'log_id' AS check_name, count(DISTINCT log_id) AS violations FROM (SELECT log_id, count(*) OVER (PARTITION BY log_id) AS times FROM {p}audit_log WHERE log_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'books' AS table_name, 'book_id' AS check_name, count(DISTINCT book_id) AS violations FROM (SELECT book_id, count(*) OVER (PARTITION BY book_id) AS times FROM {p}books WHERE book_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'books' AS table_name, 'isbn' AS check_name, count(DISTINCT isbn) AS violations FROM (SELECT isbn, count(*) OVER (PARTITION BY isbn) AS times FROM {p}books WHERE isbn IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'book_copies' AS table_name, 'copy_id' AS check_name, count(DISTINCT copy_id) AS violations FROM (SELECT copy_id, count(*) OVER (PARTITION BY copy_id) AS times FROM {p}book_copies WHERE copy_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'book_copies' AS table_name, 'book_id,copy_number' AS check_name, count(DISTINCT (book_id, copy_number)) AS violations FROM (SELECT book_id, copy_number, count(*) OVER (PARTITION BY book_id, copy_number) AS times FROM {p}book_copies WHERE book_id IS NOT NULL AND copy_number IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'loans' AS table_name, 'loan_id' AS check_name, count(DISTINCT loan_id) AS violations FROM (SELECT loan_id, count(*) OVER (PARTITION BY loan_id) AS times FROM {p}loans WHERE loan_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'fines' AS table_name, 'fine_id' AS check_name, count(DISTINCT fine_id) AS violations FROM (SELECT fine_id, count(*) OVER (PARTITION BY fine_id) AS times FROM {p}fines WHERE fine_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'event_registrations' AS table_name, 'registration_id' AS check_name, count(DISTINCT registration_id) AS violations FROM (SELECT registration_id, count(*) OVER (PARTITION BY registration_id) AS times FROM {p}event_registrations WHERE registration_id IS NOT NULL) WHERE times > 1
UNION ALL SELECT 'unique' AS rule, 'event_registrations' AS table_name, 'event_id,member_id' AS check_name, count(DISTINCT (event_id, member_id)) AS violations FROM (SELECT event_id, member_id, count(*) OVER (PARTITION BY event_id, member_id) AS times FROM {p}event_registrations WHERE event_id IS NOT NULL AND member_id IS NOT NULL) WHERE times > 1"""

FOREIGN_KEY_SQL = """
SELECT 'foreign_key' AS rule, 'books' AS table_name, 'author_id->authors.author_id' AS check_name, count(*) AS violations FROM (SELECT author_id FROM {p}books WHERE author_id IS NOT NULL) ANTI JOIN {p}authors USING (author_id)
UNION ALL SELECT 'foreign_key' AS rule, 'book_copies' AS table_name, 'book_id->books.book_id' AS check_name, count(*) AS violations FROM (SELECT book_id FROM {p}book_copies WHERE book_id IS NOT NULL) ANTI JOIN {p}books USING (book_id)
UNION ALL SELECT 'foreign_key' AS rule, 'loans' AS table_name, 'member_id->members.member_id' AS check_name, count(*) AS violations FROM (SELECT member_id FROM {p}loans WHERE member_id IS NOT NULL) ANTI JOIN {p}members USING (member_id)
UNION ALL SELECT 'foreign_key' AS rule, 'loans' AS table_name, 'copy_id->book_copies.copy_id' AS check_name, count(*) AS violations FROM (SELECT copy_id FROM {p}loans WHERE copy_id IS NOT NULL) ANTI JOIN {p}book_copies USING (copy_id)
UNION ALL SELECT 'foreign_key' AS rule, 'fines' AS table_name, 'loan_id->loans.loan_id' AS check_name, count(*) AS violations FROM (SELECT loan_id FROM {p}fines WHERE loan_id IS NOT NULL) ANTI JOIN {p}loans USING (loan_id)
UNION ALL SELECT 'foreign_key' AS rule, 'event_registrations' AS table_name, 'event_id->lib_events.event_id' AS check_name, count(*) AS violations FROM (SELECT event_id FROM {p}event_registrations WHERE event_id IS NOT NULL) ANTI JOIN {p}lib_events USING (event_id)
UNION ALL SELECT 'foreign_key' AS rule, 'event_registrations' AS table_name, 'member_id->members.member_id' AS check_name, count(*) AS violations FROM (SELECT member_id FROM {p}event_registrations WHERE member_id IS NOT NULL) ANTI JOIN {p}members USING (member_id)"""

#: New rows whose defaulted columns are left out where the key is even.
DEFAULTS_SQL = {
    "members": """SELECT member_id, CASE WHEN member_id % 2 = 0 THEN 'standard' ELSE membership_type END AS membership_type,
  CASE WHEN member_id % 2 = 0 THEN 'active' ELSE status END AS status,
  CASE WHEN member_id % 2 = 0 THEN DATE '2001-06-30' ELSE join_date END AS join_date FROM members""",
    "audit_log": """SELECT member_id AS log_id, TIMESTAMP '2001-06-30 00:00:00' AS changed_at, 'SYSTEM' AS changed_by FROM members""",
    "books": "SELECT book_id, CASE WHEN book_id % 2 = 0 THEN 1 ELSE total_copies END AS total_copies FROM books",
    "book_copies": "SELECT copy_id, CASE WHEN copy_id % 2 = 0 THEN 'good' ELSE condition_status END AS condition_status FROM book_copies",
    "loans": "SELECT loan_id, CASE WHEN loan_id % 2 = 0 THEN 'active' ELSE status END AS status FROM loans",
    "fines": "SELECT fine_id, CASE WHEN fine_id % 2 = 0 THEN false ELSE paid END AS paid FROM fines",
    "event_registrations": """SELECT registration_id,
  CASE WHEN registration_id % 2 = 0 THEN DATE '2001-06-30' ELSE registration_date END AS registration_date FROM event_registrations""",
}

#: What deleting every row of a table comes to.
DELETES_SQL = {
    "v7_authors_blocked": "SELECT author_id FROM authors SEMI JOIN books USING (author_id)",
    "v7_authors_deleted": "SELECT author_id FROM authors ANTI JOIN books USING (author_id)",
    "v7_members_blocked": "SELECT member_id FROM members SEMI JOIN loans USING (member_id)",
    "v7_members_deleted": "SELECT member_id FROM members ANTI JOIN loans USING (member_id)",
    "v7_members_registrations": """
SELECT member_id, registration_id FROM event_registrations SEMI JOIN members USING (member_id) ANTI JOIN loans USING (member_id)""",
    "v7_loans_fines": "SELECT loan_id, fine_id FROM fines SEMI JOIN loans USING (loan_id)",
    "v7_events_registrations": "SELECT event_id, registration_id FROM event_registrations SEMI JOIN lib_events USING (event_id)",
}
