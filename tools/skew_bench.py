"""Plain window forms vs the scalable operators on data with a hot key.

usage: python tools/skew_bench.py [rows]   (default 24,000,000)

Rows are generated in memory (spark.range): one key holds a third of all
rows, the rest spread over many keys. Each variant is run to completion into
the no-op sink; wall time and the largest task's share of input rows are
printed as a Markdown table.
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from folio.operators.lag import chunked_lag  # noqa: E402
from folio.operators.ranking import rank_by_value, sequence_within  # noqa: E402
from folio.session import build_session  # noqa: E402


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 24_000_000
    spark = build_session("local[8]", app_name="folio-skew", shuffle_partitions=64)
    spark.sparkContext.setLogLevel("ERROR")
    data = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)) + 1).alias("k"),
        (F.pmod(F.xxhash64(F.col("id") * 7), F.lit(1000))).alias("v"),
        (F.col("id") % 1000).alias("day"))
    cases = [
        ("LAG per key", lambda: data.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("day", "id"))),
         lambda: chunked_lag(data, ["k"], ["day", "id"], "v", "day", "p")),
        ("ROW_NUMBER per key", lambda: data.withColumn("s", F.row_number().over(Window.partitionBy("k").orderBy("id"))),
         lambda: sequence_within(data, ["k"], ["id"], out_col="s")),
        ("RANK, no PARTITION BY", lambda: data.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc()))),
         lambda: rank_by_value(data, "v", descending=True, rank_col="r", dense_col=None, block_width=64)),
    ]
    print(f"| operation ({n:,} rows, one key = 1/3) | plain window s | folio operator s |")
    print("|---|---|---|")
    for name, plain, scalable in cases:
        timed(scalable())                      # warm-up of the code paths
        t_plain, t_op = timed(plain()), timed(scalable())
        print(f"| {name} | {t_plain:.1f} | {t_op:.1f} |", flush=True)


if __name__ == "__main__":
    main()
