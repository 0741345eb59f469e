"""Reachability in a two-sided graph, by the frontier.

The links stay rows of (left, right): a step goes from the left nodes of the frontier to their right nodes and back to left nodes, so
a right node with a third of all links is met once and never pairs its neighbours. What a step finds is written; the next
step reads only that. In an undirected graph a node's neighbours lie one step before, beside or after it, so a step
is held against the step before it alone, not against all that was seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from folio.session import scratch_dir


def reach(links: DataFrame, left: str, right: str, seeds: DataFrame, max_steps: int | None = None) -> DataFrame:
    """``left, steps``: the left nodes reachable from ``seeds`` (a column ``left``), with the fewest steps to them; seeds have 0.

    A seed without links is reached by itself. Null nodes link nothing. Ends when a step finds nothing new, or after
    ``max_steps``. Cycles and repeated links change nothing.
    """
    spark = links.sparkSession
    root = f"{scratch_dir(spark, 'reach')}/{uuid.uuid4().hex}"

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    edges = written(links.select(left, right).where(f"`{left}` IS NOT NULL AND `{right}` IS NOT NULL").distinct(), "links")
    frontier = written(seeds.select(left).where(f"`{left}` IS NOT NULL").distinct(), "found/steps=0")
    before, steps = None, 0
    while (max_steps is None or steps < max_steps) and not frontier.isEmpty():
        steps += 1
        over = edges.join(frontier, left, "left_semi").select(right).distinct()
        over = written(over if before is None else over.join(before, right, "left_anti"), f"over-{steps}")
        found = edges.join(over, right, "left_semi").select(left).distinct()
        frontier, before = written(found.join(frontier, left, "left_anti"), f"found/steps={steps}"), over
    return spark.read.schema(StructType([*frontier.schema.fields, StructField("steps", IntegerType())])).parquet(f"{root}/found").select(left, F.col("steps"))
