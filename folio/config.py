"""Pinned values shared by the Spark jobs and the oracle SQL.

Reports never read the wall clock: every "today" is an explicit as-of date.
"""

import datetime as _dt

# The as-of dates that replace CURDATE() for the fixture data.
AS_OF = _dt.date(2001, 6, 30)          # loans, members, fines, batch jobs
AS_OF_EVENTS = _dt.date(2024, 1, 17)   # library events and registrations

# Business constants of the lending rules.
LOAN_DAYS = 14            # due date = loan date + 14 days
FINE_PER_DAY = "0.25"     # fine rate per late day, DECIMAL(5,2)
MAX_ACTIVE_LOANS = 5      # checkout-with-limit cap
RECENT_JOIN_DAYS = 180    # "joined in the last 6 months"
UPCOMING_EVENT_DAYS = 30  # "upcoming events this month"
MEMBERSHIP_FEE = 100      # revenue per joining member
