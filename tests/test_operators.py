"""The scalable operators give exactly what the plain window / join forms give.

Block widths and hot-key thresholds are set tiny so that the multi-block and
salted paths are exercised on small random data, including a hot key that
holds a third of all rows."""
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from folio.functions.scalar import ratio_round
from folio.operators.lag import chunked_lag
from folio.operators.pairs import pairs_within_key
from folio.operators.ranking import (percent_rank_by_value, rank_by_value, running_total_by_key,
                                     sequence_within)
from folio.operators.topk import keep_top_k_with_ties


def skewed_rows(n=600, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 25)          # key 0 holds a third of the rows
        out.append((i * 3 + rnd.randint(0, 2), key, rnd.randint(0, 12),
                    dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 400)),
                    None if rnd.random() < 0.1 else rnd.randint(0, 9)))
    return out


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(skewed_rows(), "id long, grp long, v long, d date, nv long")


@pytest.mark.parametrize("width,hot", [(1, 0), (7, 0), (64, 30), (7, 1 << 20), (1 << 16, 0)])
def test_sequence_within_matches_row_number(df, width, hot):
    got = sequence_within(df, ["grp"], ["id"], out_col="s", block_width=width, hot_rows=hot)
    want = df.withColumn("s", F.row_number().over(Window.partitionBy("grp").orderBy("id")).cast("long"))
    assert sorted(rows(got, "id", "s")) == sorted(rows(want, "id", "s"))


def test_sequence_without_groups(df):
    got = sequence_within(df, [], ["id"], out_col="s", block_width=16)
    want = df.withColumn("s", F.row_number().over(Window.orderBy("id")).cast("long"))
    assert sorted(rows(got, "id", "s")) == sorted(rows(want, "id", "s"))


@pytest.mark.parametrize("desc", [True, False])
@pytest.mark.parametrize("col,width", [("v", 1 << 16), ("v", 2), ("nv", 3), ("id", 50)])
def test_rank_by_value(df, desc, col, width):
    order = F.col(col).desc() if desc else F.col(col).asc()      # SQL null order: first asc, last desc
    want = df.select("id", F.rank().over(Window.orderBy(order)).cast("long").alias("r"),
                     F.dense_rank().over(Window.orderBy(order)).cast("long").alias("dr"))
    got = rank_by_value(df, col, descending=desc, rank_col="r", dense_col="dr", block_width=width)
    assert sorted(rows(got, "id", "r", "dr")) == sorted(rows(want, "id", "r", "dr"))


@pytest.mark.parametrize("width", [1 << 16, 0.5, 4])
def test_rank_by_decimal_value(spark, width):
    data = spark.createDataFrame([(i, Decimal(i * 37 % 101) / 4) for i in range(300)], "id long, amt decimal(10,2)")
    want = data.select("id", F.rank().over(Window.orderBy("amt")).cast("long").alias("r"))
    got = rank_by_value(data, "amt", descending=False, rank_col="r", dense_col=None, block_width=width)
    assert sorted(rows(got, "id", "r")) == sorted(rows(want, "id", "r"))


def test_percent_rank_by_value(df):
    got = percent_rank_by_value(df, "v", out_rank="r", out_n="n", block_width=3).select(
        "id", ((F.col("r") - 1) / (F.col("n") - 1)).alias("p"))
    want = df.select("id", F.percent_rank().over(Window.orderBy("v")).alias("p"))
    g = dict(rows(got, "id", "p"))
    for k, p in rows(want, "id", "p"):
        assert abs(g[k] - p) < 1e-12


def test_running_total_by_key_with_nulls_and_peers(df):
    got = running_total_by_key(df, "nv", "v", "rt", nulls_first=True)
    w = Window.orderBy(F.col("nv").asc_nulls_first())
    want = df.withColumn("rt", F.sum("v").over(w))
    assert sorted(rows(got, "id", "rt")) == sorted(rows(want, "id", "rt"))


@pytest.mark.parametrize("chunk", ["month", "year", "one"])
@pytest.mark.parametrize("hot", [0, 30, 1 << 20])
def test_chunked_lag_matches_lag(df, chunk, hot):
    chunk_col = {"month": F.year("d") * 12 + F.month("d"), "year": F.year("d"), "one": F.lit(0)}[chunk]
    data = df.withColumn("c", chunk_col)
    got = chunked_lag(data, ["grp"], ["d", "id"], "v", "c", "prev", hot_rows=hot)
    want = data.withColumn("prev", F.lag("v").over(Window.partitionBy("grp").orderBy("d", "id")))
    assert sorted(rows(got, "id", "prev")) == sorted(rows(want, "id", "prev"), key=lambda r: r)


@pytest.mark.parametrize("hot", [1, 5, 40, 1_000_000])
def test_pairs_within_key_matches_self_join(df, hot):
    keyed = df.withColumn("k", F.when(F.col("nv").isNull(), None).otherwise(F.col("grp")))
    got = pairs_within_key(keyed, "k", "id", ["v"], hot_rows=hot)
    a, b = keyed.alias("a"), keyed.alias("b")
    want = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.id") < F.col("b.id"))).select(
        F.col("a.k"), F.col("a.id"), F.col("a.v"), F.col("b.id"), F.col("b.v"))
    assert sorted(rows(got, "k", "a_id", "a_v", "b_id", "b_v")) == sorted(rows(want))


@pytest.mark.parametrize("k", [1, 5, 50, 10_000])
def test_keep_top_k_with_ties(df, k):
    got = {r[0] for r in rows(keep_top_k_with_ties(df, "v", k), "id")}
    ordered = sorted(rows(df, "v"), reverse=True)
    cut = ordered[min(k, len(ordered)) - 1][0]
    want = {r[0] for r in rows(df.filter(F.col("v") >= cut), "id")}
    assert got == want


def test_ratio_round_is_exact_half_up(spark):
    pairs = [(n, d) for n in range(0, 60) for d in range(1, 17)] + [(1, 8), (5, 8), (3, 40), (0, 0)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = rows(df.select("n", "d", ratio_round(F.col("n"), F.col("d"), 2, mult=100).alias("r")))
    for n, d, r in got:
        if d == 0:
            assert r is None
            continue
        want = (Decimal(n * 100) / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert r == float(want), (n, d, r, want)
