"""Operators over time and versions of tables against plain Python, with ties, nulls, repeats and a hot key."""
import datetime as dt
import random
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, rows
from folio.operators.carry import asof_join, running_last, sessions
from folio.operators.intervals import overlapping_pairs, peak_open
from folio.plans import temporal
from folio.sources.catalog import library_for
from folio.sources.versions import VersionedTable

DAY = "datediff(_time, DATE'1970-01-01')"


def day(n):
    return None if n is None else dt.date(2020, 1, 1) + dt.timedelta(days=n)


def timed(rnd, n, first=0):
    """(key, day, id, value): key 0 holds a third of the rows, many days are equal, some keys and days are missing."""
    return [(None if rnd.random() < 0.05 else 0 if rnd.random() < 0.35 else rnd.randint(1, 6),
             None if rnd.random() < 0.05 else rnd.randint(0, 25), first + i, rnd.choice([None, "a", "b"])) for i in range(n)]


@pytest.mark.parametrize("hot", [0, 20, 1 << 20])
@pytest.mark.parametrize("strict", [True, False])
def test_asof_join_matches_brute_force(spark, hot, strict):
    rnd = random.Random(hot + strict)
    left, right = timed(rnd, 150), timed(rnd, 200, first=70)
    make = lambda data, c: spark.createDataFrame([(k, day(t), i, v) for k, t, i, v in data], f"k long, {c} date, {c}_id long, v string")
    got = asof_join(make(left, "l"), make(right, "r"), "k", "l", "r", "l_id", "r_id", ["r", "v"], DAY, strict, hot)
    want = []
    for k, t, i, v in left:
        found = [(rt, ri, rv) for rk, rt, ri, rv in right if k is not None and t is not None and rk == k and rt is not None and (rt < t or (rt == t and not strict))]
        best = max(found, key=lambda x: x[:2], default=(None, None, None))
        want.append((k, day(t), i, v, best[1], day(best[0]), best[2]))
    assert sorted(map(str, rows(got))) == sorted(map(str, want))


def test_asof_join_of_empty_sides(spark):
    some = spark.createDataFrame([(1, day(3), 1)], "k long, t date, id long")
    none, other = some.where("false"), some.withColumnRenamed("id", "oid")
    assert rows(asof_join(some, other.where("false"), "k", "t", "t", "id", "oid", ["t"], DAY)) == [(1, day(3), 1, None, None)]
    assert rows(asof_join(none, other, "k", "t", "t", "id", "oid", ["t"], DAY)) == []


@pytest.mark.parametrize("hot", [0, 15, 1 << 20])
def test_running_last(spark, hot):
    rnd = random.Random(hot)
    data = [(k or 0, t or 0, i, (t or 0) * 1000 + i if rnd.random() < 0.3 else None) for k, t, i, _ in timed(rnd, 250)]
    got = running_last(spark.createDataFrame(data, "k long, t int, id int, x int"), ["k"], ["t", "id"], "x", "t", "o", hot)
    want, last = [], {}
    for k, t, i, x in sorted(data, key=lambda r: (r[1], r[2])):
        last[k] = x if x is not None else last.get(k)
        want.append((k, t, i, x, last[k]))
    assert sorted(map(str, rows(got))) == sorted(map(str, want))


@pytest.mark.parametrize("hot", [0, 20, 1 << 20])
def test_sessions_match_brute_force(spark, hot):
    rnd = random.Random(hot + 5)
    start = dt.datetime(2024, 1, 1)
    data = [(None if rnd.random() < 0.1 else 7 if rnd.random() < 0.4 else rnd.randint(0, 5), i, None if rnd.random() < 0.05 else start + dt.timedelta(minutes=rnd.randint(0, 6000))) for i in range(400)]
    data += [(7, 1000 + i, start + dt.timedelta(minutes=30 * i)) for i in range(150)]  # pauses of just the gap, over days
    df = spark.createDataFrame(data, "u long, id long, ts timestamp_ntz")
    got = sessions(df, "u", "ts", "id", "INTERVAL '30' MINUTE", "datediff(cast(ts AS DATE), DATE'1970-01-01')", hot)
    by, want = defaultdict(list), []
    for u, _, ts in data:
        if ts is not None:
            by[u].append(ts)
    for u, times in by.items():
        times.sort()
        run = [times[0]]
        for ts in times[1:]:
            if ts - run[-1] > dt.timedelta(minutes=30):
                want.append((u, run[0], run[-1], len(run)))
                run = []
            run.append(ts)
        want.append((u, run[0], run[-1], len(run)))
    assert sorted(map(str, rows(got))) == sorted(map(str, want))


def lasting(rnd, n):
    out = []
    for i in range(n):
        s = rnd.randint(-30, 60)
        out.append((None if rnd.random() < 0.05 else 0 if i % 3 == 0 else rnd.randint(1, 9), i, None if rnd.random() < 0.05 else s,
                    None if rnd.random() < 0.05 else s + rnd.choice([-3, 0, 1, 1, 2, 7, 40])))
    return out


@pytest.mark.parametrize("width,cell", [(1, 2), (8, 3), (1000, 5), (16, 1 << 12)])
def test_overlapping_pairs_match_brute_force(spark, width, cell):
    data = lasting(random.Random(width), 120)
    got = overlapping_pairs(spark.createDataFrame(data, "k long, id long, s int, e int"), "k", "id", "s", "e", width, cell)
    usable = [r for r in data if None not in r and r[2] < r[3]]
    want = [(a[0], a[1], b[1], b[2], min(a[3], b[3])) for a in usable for b in usable if a[0] == b[0] and (a[2], a[1]) < (b[2], b[1]) and b[2] < a[3]]
    assert Counter(rows(got)) == Counter(want)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_peak_open_matches_brute_force(spark, width):
    data = lasting(random.Random(width + 50), 200)
    got = peak_open(spark.createDataFrame(data, "k long, id long, s int, e int").where("k is not null"), ["k"], "s", "e", width)
    want = []
    usable = [r for r in data if None not in r and r[2] < r[3]]
    for k in {r[0] for r in usable}:
        count = Counter(t for r in usable if r[0] == k for t in range(r[2], r[3]))
        most = max(count.values())
        want.append((k, most, min(t for t, n in count.items() if n == most)))
    assert sorted(rows(got)) == sorted(want)


def test_plans_have_no_pairs_and_no_python(spark):
    lib = library_for(spark, SF0001)
    for df in (temporal.x1_payment_after_loan(lib), temporal.x2_copies_lent_twice(lib), temporal.x3_peak_open_loans(lib), temporal.x4_click_sessions(spark, SF0001)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("NestedLoop", "Cartesian", "Python", "SinglePartition"))


# Versions of tables

COLUMNS = "id long, v string"


@pytest.fixture()
def table(spark):
    schema = spark.createDataFrame([], COLUMNS).schema
    base = tempfile.mkdtemp(prefix="folio-v-") + "/base"
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n")], COLUMNS).write.parquet(base)
    t = VersionedTable(spark, tempfile.mkdtemp(prefix="folio-v-"), schema, ["id"])
    t.start_from(base)
    return t


def batch(spark, *data):
    return spark.createDataFrame(list(data), COLUMNS)


def content(t, number=None):
    return sorted(map(str, rows(t.read(number))))


def test_versions_follow_batches(spark, table):
    assert content(table) == sorted(map(str, [(1, "a"), (2, "b"), (2, "b"), (None, "n")]))
    table.commit("one", inserts=batch(spark, (3, "c"), (None, "m")), updates=batch(spark, (2, "B"), (9, "new"), (None, "k")))
    after = sorted(map(str, [(1, "a"), (2, "B"), (9, "new"), (None, "n"), (None, "k"), (3, "c"), (None, "m")]))
    assert content(table) == after
    table.commit("two", updates=batch(spark, (2, "BB"), (3, "C")))
    last = sorted(map(str, [(1, "a"), (2, "BB"), (9, "new"), (None, "n"), (None, "k"), (3, "C"), (None, "m")]))
    assert content(table) == last and content(table, 1) == after and table.numbers() == [0, 1, 2]
    assert table.compact("fold").number == 3 and content(table) == last and not table.version().replaced and len(table.version().rows) == 1
    table.commit("three", updates=batch(spark, (1, "A")))
    assert content(table) == sorted([str((1, "A")), *(x for x in last if x != str((1, "a")))])


def test_repeated_batch_changes_nothing(spark, table):
    first = table.commit("one", inserts=batch(spark, (3, "c")))
    assert table.commit("one", inserts=batch(spark, (4, "d"))) == first and table.numbers() == [0, 1]
    assert table.start_from(table.version(0).rows[0][1]).number == 0


def test_half_written_version_is_none(spark, table):
    before = content(table)
    broken = batch(spark, (5, "x")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.commit("one", inserts=batch(spark, (4, "d")), updates=broken)
    assert content(table) == before and table.numbers() == [0]  # the inserted rows were written, but are in no version
    table.commit("one", inserts=batch(spark, (4, "d")))
    assert content(table) == sorted([*before, str((4, "d"))])


def test_two_writers_make_two_versions(spark, table, monkeypatch):
    """A writer that saw version 0 finds number 1 taken and builds on it."""
    other = VersionedTable(spark, table.path, table.schema, ["id"])
    publish, met = VersionedTable._publish, []

    def meet(self, version):
        if self is table and not met:
            met.append(version.number)
            other.commit("theirs", inserts=batch(spark, (8, "t")))
        return publish(self, version)

    monkeypatch.setattr(VersionedTable, "_publish", meet)
    assert table.commit("ours", inserts=batch(spark, (7, "o"))).number == 2 and met == [1]
    assert {str((8, "t")), str((7, "o"))} <= set(content(table))


def test_table_without_versions_and_empty_batches(spark):
    t = VersionedTable(spark, tempfile.mkdtemp(prefix="folio-v-"), spark.createDataFrame([], COLUMNS).schema, ["id"])
    with pytest.raises(LookupError):
        t.read()
    t.commit("nothing")
    assert content(t) == []
    t.commit("none", inserts=batch(spark).where("false"), updates=batch(spark).where("false"))
    assert content(t) == [] and t.numbers() == [0, 1]
