"""What large or skewed inputs would break: sorts on few values, sparse ids, exact ratios, broken
rules, changed inputs."""
import datetime as dt
import os
import tempfile

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF0001, rows
from folio.functions.scalar import ratio_round
from folio.operators import ranking
from folio.plans import joins, windows
from folio.quality.dirty import dirty_library
from folio.quality.rules import delete_plan, foreign_keys, row_rules, unique_keys
from folio.sources import catalog
from folio.sources.library import Library


def task_sizes(spark, df, parts=8):
    """Rows of each task of the result, with as many tasks as the sort makes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def people(n, address=None):
    return [(i, f"F{i}", f"L{i}", f"m{i}@x", None, address, dt.date(2001, 1, 1), "standard", "active") for i in range(n)]


def test_pairs_of_one_address_spread_over_the_sort(spark):
    lib = Library.from_rows(spark, members=people(300, "one house"))
    sizes = task_sizes(spark, joins.q5_8_same_address_pairs(lib))
    assert sum(sizes) == 300 * 299 // 2 and len(sizes) > 4 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_one_event_date_spreads_over_the_sort(spark):
    lib = Library.from_rows(spark, members=people(4000), lib_events=[(1, "E", dt.date(2024, 2, 1), "book_club", 10)],
                            event_registrations=[(i, 1, i, dt.date(2024, 1, 1)) for i in range(4000)])
    sizes = task_sizes(spark, windows.q8_5_next_event(lib))
    assert sum(sizes) == 4000 and len(sizes) > 4 and max(sizes) < 2 * sum(sizes) / len(sizes)


@pytest.mark.parametrize("gap", [1, 1 << 22, 1 << 40])
def test_numbering_of_sparse_ids(spark, gap, monkeypatch):
    """Blocks are summed in levels: no window holds more blocks than a level."""
    monkeypatch.setattr(ranking, "LEVEL_WIDTH", 16)
    ids = [gap * i for i in range(3000)]
    df = spark.createDataFrame([(x,) for x in ids], "id long").repartition(7)
    got = dict(rows(ranking.sequence_within(df, [], ["id"], block_width=8)))
    assert got == {x: i + 1 for i, x in enumerate(ids)}
    ranked = ranking.rank_by_value(df.union(df), "id", descending=False, block_width=8)
    assert {(r["id"], r["rank"], r["dense_rank"]) for r in ranked.collect()} == {(x, 2 * i + 1, i + 1) for i, x in enumerate(ids)}


def test_ratios_are_exact(spark):
    cases = [(1_000_000_000_001, 3, 4, 333333333333.6667), (-5, 2, 0, -3.0), (-1, 3, 2, -0.33), (5, 2, 0, 3.0), (0, 7, 2, 0.0)]
    for num, den, scale, want in cases:
        df = spark.createDataFrame([(num, den)], "n long, d long")
        assert df.select(ratio_round(F.col("n"), F.col("d"), scale)).first()[0] == want
    assert spark.createDataFrame([(1, 0)], "n long, d long").select(ratio_round(F.col("n"), F.col("d"), 2)).first()[0] is None


def test_every_rule_is_broken_in_the_dirty_library(spark, sf0001_lib):
    dirty = dirty_library(spark, sf0001_lib)
    for rules in (row_rules, unique_keys, foreign_keys):
        found = rules(dirty).collect()
        assert found and all(r["violations"] > 0 for r in found), [r for r in found if not r["violations"]]
        assert all(r["violations"] == 0 for r in rules(sf0001_lib).collect())


def test_a_restricted_row_below_a_cascade_blocks_the_delete(spark):
    """A book goes with its copies, unless one of them was ever lent."""
    day = dt.date(2001, 1, 1)
    lib = Library.from_rows(
        spark, authors=[(1, "A", 1950, "X")], books=[(i, f"T{i}", 1, f"i{i}", 2000, "G", 1) for i in (1, 2)],
        book_copies=[(11, 1, 1, "good", day), (21, 2, 1, "good", day)], members=people(2),
        loans=[(1, 0, 21, day, day, None, "lost")])
    plan = delete_plan("books", lib)
    assert rows(plan["blocked"]) == [(2,)] and rows(plan["deleted"]) == [(1,)] and rows(plan["cascade_book_copies"]) == [(1, 11)]
    authors = delete_plan("authors", lib)
    assert rows(authors["blocked"]) == [(1,)] and rows(authors["deleted"]) == []


def test_changed_input_is_decided_anew(spark, monkeypatch):
    """Rewritten data under the same names: other loans, and other outputs of a job that ran before."""
    from folio.jobs.registry import JOB_QUERIES

    monkeypatch.setitem(catalog._state, "root", tempfile.mkdtemp(prefix="folio-t-"))
    folder = tempfile.mkdtemp(prefix="folio-t-") + "/data"
    os.makedirs(folder)
    for name in os.listdir(SF0001):
        pq.write_table(pq.read_table(f"{SF0001}/{name}"), f"{folder}/{name}")
    before = JOB_QUERIES["w3_updated_loans"](spark, folder).count()
    orders = pq.read_table(f"{SF0001}/orders.parquet")
    pq.write_table(orders.filter((pc.field("o_orderstatus") != "O") | (pc.field("o_orderkey") < 600)), f"{folder}/orders.parquet")
    after = JOB_QUERIES["w3_updated_loans"](spark, folder).count()
    assert 0 < after < before


def test_failing_to_store_the_tables_is_an_error(spark, monkeypatch):
    monkeypatch.setitem(catalog._state, "root", "/proc/no/such/folder")
    monkeypatch.setitem(catalog._state, "ready", set())
    with pytest.raises(Exception):
        catalog.library_for(spark, SF0001)
