"""Messages of the batch jobs.

Fixed values: the texts the reference's routines and triggers return, kept
verbatim so callers see the same messages; the last group covers requests
the reference would have failed with a constraint error.
"""

MEMBER_NOT_FOUND = "Member not found."
MEMBER_NOT_ACTIVE = "Member not active."
COPY_NOT_FOUND = "Book copy not found."
COPY_NOT_AVAILABLE = "Book copy not available."
CHECKED_OUT_PREFIX = "Book checked out. Due on "

LOAN_NOT_FOUND = "Loan not found or already returned."
RETURNED_LATE_PREFIX = "Returned late by "
RETURNED_LATE_MIDDLE = " days. Fine $"
RETURNED_ON_TIME = "Returned on time. No fine."

NO_COPY_AVAILABLE = "No available copy to checkout"
CHECKOUT_SUCCESSFUL = "Checkout successful"
AUDIT_CHECKED_OUT = "Book checked out"
FINE_PAID_PREFIX = "Fine paid: $"

COMMITTED = "Transaction committed successfully"
ROLLED_BACK = "Transaction rolled back: Member has too many active loans"

BATCH_RETURN_PREFIX = "Batch return for member "
BATCH_RETURN_SUFFIX = " books"

MEMBER_UPDATED_PREFIX = "Member "
MEMBER_UPDATED_STATUS = " updated. Status: "
STATUS_ARROW = " -> "

LOAN_REJECTED_INACTIVE = "Cannot create loan: Member is not active"
BOOK_DELETE_BLOCKED = "Cannot delete book: Active loans exist"

# Requests that would break a foreign key in the reference.
UNKNOWN_MEMBER = "Cannot create loan: unknown member"
UNKNOWN_COPY = "Cannot create loan: unknown book copy"
