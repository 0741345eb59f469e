"""Batch jobs equal calling the routine once per request, in request order.

The reference routines are re-implemented here as a plain-Python loop over a
dictionary state (test code only) and compared with the set-based jobs on
small random libraries with colliding requests (same copy, same book, same
member, unknown ids)."""
import datetime as dt
import random
from decimal import Decimal

import pytest

from conftest import rows
from folio.jobs import messages as msg
from folio.jobs.checkout import checkout_batch, checkout_with_limit_batch, safe_checkout_batch
from folio.jobs.payments import pay_fines_batch
from folio.jobs.returns import batch_return, return_batch
from folio.sources.library import Library

AS_OF = dt.date(2001, 6, 30)
DUE = AS_OF + dt.timedelta(days=14)
STATUSES = ["active"] * 6 + ["suspended", "expired"]


def make_state(seed):
    rnd = random.Random(seed)
    members = {m: rnd.choice(STATUSES) for m in range(1, 31)}
    copies = {}
    for b in range(1, 21):
        for n in range(1, rnd.randint(1, 3) + 1):
            copies[b * 10 + n] = b
    loans, fines = {}, {}
    for lid in range(1, 161):
        ld = AS_OF - dt.timedelta(days=rnd.randint(1, 60))
        st = rnd.choice(["active", "active", "returned", "lost"])
        ret = ld + dt.timedelta(days=rnd.randint(1, 25)) if st == "returned" else None
        if ret and ret > AS_OF:
            ret = AS_OF
        loans[lid] = dict(member=rnd.choice(list(members)), copy=rnd.choice(list(copies)), loan_date=ld,
                          due=ld + dt.timedelta(days=14), ret=ret, status=st)
    fid = 1
    for lid in loans:
        for _ in range(rnd.choice([0, 0, 1, 2])):
            paid = rnd.random() < 0.4
            fines[fid] = dict(loan=lid, amount=(Decimal(rnd.randint(1, 500)) / 100).quantize(Decimal("0.01")),
                              reason=rnd.choice(["overdue", "damage", "lost"]), paid=paid,
                              pdate=AS_OF - dt.timedelta(days=3) if paid else None)
            fid += 1
    return rnd, members, copies, loans, fines


def to_library(spark, members, copies, loans, fines):
    m_rows = [(m, f"F{m}", f"L{m}", f"m{m}@x", None, None, dt.date(2000, 1, 1), "standard", s)
              for m, s in members.items()]
    b_rows = [(b, f"T{b}", 1, f"isbn{b}", 2000, "G", 1) for b in sorted(set(copies.values()))]
    c_rows = [(c, b, c % 10, "good", None) for c, b in copies.items()]
    l_rows = [(lid, l["member"], l["copy"], l["loan_date"], l["due"], l["ret"], l["status"])
              for lid, l in loans.items()]
    f_rows = [(fid, f["loan"], f["amount"], f["reason"], f["paid"], f["pdate"]) for fid, f in fines.items()]
    return Library.from_rows(spark, members=m_rows, books=b_rows, book_copies=c_rows, loans=l_rows,
                             fines=f_rows, authors=[(1, "A", None, None)])


def on_loan(loans, copy):
    return any(l["copy"] == copy and l["status"] == "active" for l in loans.values())


def insert_loan(loans, member, copy):
    lid = max(loans) + 1
    loans[lid] = dict(member=member, copy=copy, loan_date=AS_OF, due=DUE, ret=None, status="active")
    return lid


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_checkout_batch_equals_sequential(spark, seed):
    rnd, members, copies, loans, fines = make_state(seed)
    lib = to_library(spark, members, copies, loans, fines)
    reqs = [(rid, rnd.choice(list(members) + [99]), rnd.choice(list(copies) + [999])) for rid in range(1, 81)]
    want_msgs, want_new = {}, []
    for rid, m, c in reqs:
        st = members.get(m)
        if st is None:
            want_msgs[rid] = msg.MEMBER_NOT_FOUND
        elif st != "active":
            want_msgs[rid] = msg.MEMBER_NOT_ACTIVE
        elif c not in copies:
            want_msgs[rid] = msg.COPY_NOT_FOUND
        elif on_loan(loans, c):
            want_msgs[rid] = msg.COPY_NOT_AVAILABLE
        else:
            want_new.append((insert_loan(loans, m, c), m, c))
            want_msgs[rid] = msg.CHECKED_OUT_PREFIX + DUE.isoformat()
    out = checkout_batch(spark.createDataFrame(reqs, "request_id long, member_id long, copy_id long"), lib, AS_OF)
    assert dict(rows(out["results"], "request_id", "message")) == want_msgs
    assert sorted(rows(out["new_loans"], "loan_id", "member_id", "copy_id")) == sorted(want_new)


@pytest.mark.parametrize("seed", [4, 5])
def test_return_batch_equals_sequential(spark, seed):
    rnd, members, copies, loans, fines = make_state(seed)
    lib = to_library(spark, members, copies, loans, fines)
    reqs = [(rid, rnd.randint(1, 180)) for rid in range(1, 120)]
    want, want_fines = {}, []
    next_fine = max(fines) + 1
    for rid, lid in reqs:
        loan = loans.get(lid)
        if loan is None or loan["status"] != "active":
            want[rid] = (Decimal("0.00"), msg.LOAN_NOT_FOUND)
            continue
        loan.update(status="returned", ret=AS_OF)
        days = max(0, (AS_OF - loan["due"]).days)
        if days > 0:
            amount = (Decimal(days) * Decimal("0.25")).quantize(Decimal("0.01"))
            want_fines.append((next_fine, lid, amount))
            next_fine += 1
            want[rid] = (amount, f"{msg.RETURNED_LATE_PREFIX}{days}{msg.RETURNED_LATE_MIDDLE}{amount}")
        else:
            want[rid] = (Decimal("0.00"), msg.RETURNED_ON_TIME)
    out = return_batch(spark.createDataFrame(reqs, "request_id long, loan_id long"), lib, AS_OF)
    got = {r[0]: (r[1], r[2]) for r in rows(out["results"], "request_id", "fine_amount", "message")}
    assert got == want
    assert sorted(rows(out["new_fines"], "fine_id", "loan_id", "fine_amount")) == sorted(want_fines)


@pytest.mark.parametrize("seed", [6, 7])
def test_safe_checkout_equals_sequential(spark, seed):
    rnd, members, copies, loans, fines = make_state(seed)
    lib = to_library(spark, members, copies, loans, fines)
    books = sorted(set(copies.values()))
    reqs = [(rid, rnd.choice(list(members) + [99]), rnd.choice(books)) for rid in range(1, 90)]
    want = {}
    for rid, m, b in reqs:
        st = members.get(m)
        if st is None:
            want[rid] = (None, msg.UNKNOWN_MEMBER)
            continue
        if st != "active":
            want[rid] = (None, msg.LOAN_REJECTED_INACTIVE)
            continue
        free = sorted(c for c, bb in copies.items() if bb == b and not on_loan(loans, c))
        if not free:
            want[rid] = (None, msg.NO_COPY_AVAILABLE)
        else:
            insert_loan(loans, m, free[0])
            want[rid] = (free[0], msg.CHECKOUT_SUCCESSFUL)
    out = safe_checkout_batch(spark.createDataFrame(reqs, "request_id long, member_id long, book_id long"),
                              lib, AS_OF)
    got = {r[0]: (r[1], r[2]) for r in rows(out["results"], "request_id", "copy_id", "message")}
    assert got == want
    assert out["audit"].count() == sum(1 for v in want.values() if v[0] is not None)


@pytest.mark.parametrize("seed", [8, 9])
def test_checkout_with_limit_equals_sequential(spark, seed):
    rnd, members, copies, loans, fines = make_state(seed)
    lib = to_library(spark, members, copies, loans, fines)
    hot = [m for m, s in members.items() if s == "active"][:3]
    reqs = [(rid, rnd.choice(hot + list(members) + [99]), rnd.choice(list(copies) + [999])) for rid in range(1, 100)]
    want = {}
    for rid, m, c in reqs:
        st = members.get(m)
        if st is None:
            want[rid] = msg.UNKNOWN_MEMBER
        elif st != "active":
            want[rid] = msg.LOAN_REJECTED_INACTIVE
        elif c not in copies:
            want[rid] = msg.UNKNOWN_COPY
        else:
            lid = insert_loan(loans, m, c)
            n_active = sum(1 for l in loans.values() if l["member"] == m and l["status"] == "active")
            if n_active > 5:
                del loans[lid]
                want[rid] = msg.ROLLED_BACK
            else:
                want[rid] = msg.COMMITTED
    out = checkout_with_limit_batch(spark.createDataFrame(reqs, "request_id long, member_id long, copy_id long"),
                                    lib, AS_OF)
    assert dict(rows(out["results"], "request_id", "message")) == want


@pytest.mark.parametrize("seed", [10, 11])
def test_pay_fines_equals_sequential(spark, seed):
    rnd, members, copies, loans, fines = make_state(seed)
    lib = to_library(spark, members, copies, loans, fines)
    reqs = [(rid, rnd.choice(list(fines) + [9999])) for rid in range(1, 60)]
    audit = []
    for rid, fid in reqs:
        f = fines.get(fid)
        if f:
            f.update(paid=True, pdate=AS_OF)
        audit.append((fid, None if f is None else f"{msg.FINE_PAID_PREFIX}{f['amount']}"))
        if f:
            m = loans[f["loan"]]["member"]
            others = [g for k, g in fines.items()
                      if k != fid and loans[g["loan"]]["member"] == m and not g["paid"]]
            if members[m] == "suspended" and not others:
                members[m] = "active-again"
    out = pay_fines_batch(spark.createDataFrame(reqs, "request_id long, fine_id long"), lib, AS_OF)
    assert sorted(rows(out["audit"], "record_id", "description"), key=str) == sorted(audit, key=str)
    assert {r[0] for r in rows(out["reactivated"], "member_id")} == {
        m for m, s in members.items() if s == "active-again"}


@pytest.mark.parametrize("seed", [12, 13])
def test_batch_return_equals_sequential(spark, seed):
    rnd, members, copies, loans, fines = make_state(seed)
    lib = to_library(spark, members, copies, loans, fines)
    who = rnd.sample(list(members), 12)
    who += rnd.sample(who, 5)  # some are asked for twice: the second call finds nothing
    want_fines, want_audit = [], []
    first_id = max(fines) + 1
    for m in who:
        for l in loans.values():
            if l["member"] == m and l["status"] == "active":
                l.update(status="returned", ret=AS_OF)
        fined = {f["loan"] for f in fines.values()}
        new = [(lid, (Decimal(max(0, (AS_OF - l["due"]).days)) * Decimal("0.25")).quantize(Decimal("0.01")))
               for lid, l in sorted(loans.items())
               if l["member"] == m and l["status"] == "returned" and l["ret"] > l["due"] and lid not in fined]
        for lid, amount in new:
            fines[max(fines) + 1] = dict(loan=lid, amount=amount, reason="overdue", paid=False, pdate=None)
        want_fines += new
        want_audit.append((m, f"{msg.BATCH_RETURN_PREFIX}{m}: {len(new)}{msg.BATCH_RETURN_SUFFIX}"))
    out = batch_return(spark.createDataFrame(list(enumerate(who, 100)), "request_id long, member_id long"), lib, AS_OF)
    assert sorted(rows(out["new_fines"], "fine_id", "loan_id", "fine_amount")) == [
        (i, *f) for i, f in enumerate(want_fines, first_id)]
    assert sorted(rows(out["audit"], "record_id", "description")) == sorted(want_audit)


def test_applied_returns_are_not_returned_twice(spark):
    """Chaining: apply W3's output to the tables, run the same requests again."""
    from folio.jobs.sink import apply_changes
    rnd, members, copies, loans, fines = make_state(21)
    lib = to_library(spark, members, copies, loans, fines)
    reqs = spark.createDataFrame([(rid, lid) for rid, lid in enumerate(range(1, 161), 1)],
                                 "request_id long, loan_id long")
    out = return_batch(reqs, lib, AS_OF)
    n_returned = out["updated_loans"].count()
    assert n_returned == sum(1 for l in loans.values() if l["status"] == "active")
    new_loans = apply_changes(lib.loans, updates=out["updated_loans"], keys=["loan_id"])
    new_fines = apply_changes(lib.fines, inserts=out["new_fines"])
    assert new_loans.count() == lib.loans.count()
    assert new_fines.count() == lib.fines.count() + out["new_fines"].count()
    lib2 = Library.from_frames(spark, members=lib.members, books=lib.books, book_copies=lib.book_copies,
                               loans=new_loans, fines=new_fines, authors=lib.authors)
    again = return_batch(reqs, lib2, AS_OF)
    assert {r[0] for r in rows(again["results"], "message")} == {msg.LOAN_NOT_FOUND}


def test_requests_with_null_keys_get_not_found_messages(spark):
    rnd, members, copies, loans, fines = make_state(31)
    lib = to_library(spark, members, copies, loans, fines)
    out = return_batch(spark.createDataFrame([(1, None), (2, 99999)], "request_id long, loan_id long"), lib, AS_OF)
    assert sorted(rows(out["results"], "request_id", "message")) == [(1, msg.LOAN_NOT_FOUND), (2, msg.LOAN_NOT_FOUND)]
    co = checkout_batch(spark.createDataFrame([(1, None, 11), (2, 1, None)], "request_id long, member_id long, "
                                              "copy_id long"), lib, AS_OF)
    got = dict(rows(co["results"], "request_id", "message"))
    assert got[1] == msg.MEMBER_NOT_FOUND
    assert got[2] in (msg.COPY_NOT_FOUND, msg.MEMBER_NOT_ACTIVE)


def test_sink_writes_versions_and_appends(spark):
    import os
    import tempfile
    from folio.jobs.sink import append_rows, write_version
    base = tempfile.mkdtemp(prefix="folio-sink-")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    write_version(df, os.path.join(base, "v1"))
    append_rows(spark.createDataFrame([(2, "b")], "id long, v string"), os.path.join(base, "v1"))
    assert sorted(rows(spark.read.parquet(os.path.join(base, "v1")))) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception):
        write_version(df, os.path.join(base, "v1"))        # never over an existing version
