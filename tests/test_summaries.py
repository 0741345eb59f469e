"""Mergeable states, grouping sets, reachability and bags of rows, against plain Python on odd rows."""
import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from conftest import SF0001, rows
from folio.operators.bags import bag_changes, bag_common
from folio.operators.cube import distinct_cube
from folio.operators.reach import reach
from folio.operators.sketches import DISTINCT_BOUND, RANK_BOUND, distinct_over, distinct_states, quantile_over, value_states
from folio.plans import summaries
from folio.sources.catalog import library_for


def ordered(found):
    return sorted(found, key=str)


# Sketches

def test_merged_months_give_the_estimate_of_all_rows(spark):
    rnd = random.Random(1)
    day = dt.date(2024, 1, 1)
    # One key holds a third of the rows, some are null; values repeat.
    data = [(None if rnd.random() < 0.02 else day + dt.timedelta(days=rnd.randrange(366)), 7 if i % 3 == 0 else None if i % 50 == 0 else rnd.randrange(30_000),
             None if i % 70 == 0 else rnd.choice([5, 10, rnd.randrange(100_000)])) for i in range(60_000)]
    df = spark.createDataFrame(data, "d date, k long, v long")
    keys, values, year = defaultdict(set), defaultdict(list), set()
    for d, k, v in data:
        if d is not None:
            q = dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)
            if k is not None:
                keys[q].add(k)
                year.add(k)
            if v is not None:
                values[q].append(v)
    states = distinct_states(df, "d", "k")
    assert states.count() == 12
    got = dict(rows(distinct_over(states, "quarter")))
    assert got.keys() == keys.keys() and all(abs(got[q] - len(keys[q])) <= DISTINCT_BOUND * len(keys[q]) for q in keys)
    whole = dict(rows(distinct_over(states, "year")))
    assert list(whole) == [day] and abs(whole[day] - len(year)) <= DISTINCT_BOUND * len(year)
    for rank in (0.1, 0.5, 0.99):
        got = dict(rows(quantile_over(value_states(df, "d", "v"), "quarter", rank)))
        assert got.keys() == values.keys()
        for q, v in values.items():
            assert sum(x < got[q] for x in v) <= (rank + RANK_BOUND) * len(v) and sum(x <= got[q] for x in v) >= (rank - RANK_BOUND) * len(v)
    none = df.where("d is null")
    assert distinct_over(distinct_states(none, "d", "k"), "year").count() == quantile_over(value_states(none, "d", "v"), "year", 0.5).count() == 0


def test_quarter_estimates_are_not_the_exact_figures_by_another_way(spark):
    plan = summaries.quarter_estimates(library_for(spark, SF0001))._jdf.queryExecution().executedPlan().toString().lower()
    assert "hll_union_agg" in plan and "kll_merge_agg" in plan


# Grouping sets

@pytest.mark.parametrize("determined", [[], ["t"]])
def test_cube_matches_brute_force(spark, determined):
    rnd = random.Random(5)
    kind = lambda k: None if k is None else "ab"[k % 2] if k else None
    data = [(None if rnd.random() < 0.1 else rnd.choice("xyz"), None if rnd.random() < 0.1 else rnd.randrange(4), k, kind(k), rnd.randint(1, 3))
            for k in (None if rnd.random() < 0.05 else 7 if i % 3 == 0 else rnd.randrange(12) for i in range(500))]
    got = distinct_cube(spark.createDataFrame(data, "g string, m int, k long, t string, n int"), ["g", "m", "t"], "k", "n", determined)
    want = []
    for size in range(4):
        for kept in combinations(range(3), size):
            total, keys = Counter(), defaultdict(set)
            for g, m, k, t, n in data:
                at = tuple(v if i in kept else None for i, v in enumerate((g, m, t)))
                total[at] += n
                keys[at] |= {k} - {None}
            want += [(*at, sum(1 << (2 - i) for i in range(3) if i not in kept), total[at], len(keys[at])) for at in total]
    assert ordered(rows(got)) == ordered(want)


def test_cube_of_no_facts_is_the_grand_total(spark):
    none = spark.createDataFrame([], "g string, t string, k long, n int")
    assert rows(distinct_cube(none, ["g", "t"], "k", "n", ["t"])) == rows(distinct_cube(none, ["g", "t"], "k", "n")) == [(None, None, 3, 0, 0)]


def test_cube_does_not_expand_facts(spark):
    plan = summaries.x7_lending_cube(library_for(spark, SF0001))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Python" not in plan


# Reachability

def brute_reach(links, seeds, most=None):
    by_left, by_right = defaultdict(set), defaultdict(set)
    for a, b in links:
        if a is not None and b is not None:
            by_left[a].add(b)
            by_right[b].add(a)
    found = {s: 0 for s in seeds if s is not None}
    frontier, step = set(found), 0
    while frontier and (most is None or step < most):
        step += 1
        frontier = {x for a in frontier for b in by_left[a] for x in by_right[b]} - found.keys()
        found.update(dict.fromkeys(frontier, step))
    return sorted(found.items())


@pytest.mark.parametrize("most", [None, 0, 2])
def test_reach_matches_brute_force(spark, most):
    rnd = random.Random(3)
    links = [(i, i) for i in range(8)] + [(i + 1, i) for i in range(8)]                       # a path
    links += [(100 + i, 100 + i) for i in range(5)] + [(100 + (i + 1) % 5, 100 + i) for i in range(5)]  # a cycle
    links += [(200 + i, 900) for i in range(40)] + [(8, 900)]                                 # a hot right node at the path's end
    links += [(rnd.randrange(300, 330), rnd.randrange(300, 330)) for _ in range(25)]
    links += [(None, 900), (5, None), *links[:10]]
    seeds = [0, 0, None, 101, 303, 5000]
    got = reach(spark.createDataFrame(links, "a long, b long"), "a", "b", spark.createDataFrame([(s,) for s in seeds], "a long"), most)
    assert sorted(rows(got)) == brute_reach(links, seeds, most)


def test_reach_from_nothing(spark):
    links = spark.createDataFrame([(1, 1)], "a long, b long")
    assert rows(reach(links, "a", "b", links.where("false"))) == []
    assert rows(reach(links.where("false"), "a", "b", links)) == [(1, 0)]


# Bags

def test_bags_match_counters(spark):
    rnd = random.Random(9)
    table = lambda n: [(7, "hot") if i % 3 == 0 else (rnd.choice([None, 1, 2, 3]), rnd.choice([None, "", "a"])) for i in range(n)]
    old, new = table(90) + [(50, "gone")] * 3, table(140) + [(None, None)]
    a, b = (spark.createDataFrame(t, "x long, y string") for t in (old, new))
    before, after = Counter(old), Counter(new)
    want = [("added", *r, n) for r, n in (after - before).items()] + [("removed", *r, n) for r, n in (before - after).items()]
    assert ordered(rows(bag_changes(a, b.select("y", "x")))) == ordered(want)
    assert ordered(rows(bag_common(a, b))) == ordered((*r, n) for r, n in (before & after).items())
    assert bag_changes(a, a).count() == 0 and bag_common(a, b.where("false")).count() == 0
