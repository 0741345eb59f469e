"""Row triggers as change-batch jobs: W9 (audit of member updates) and W14
(guard against deleting books with active loans)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.jobs import messages as msg
from folio.sources.library import Library


def audit_member_updates(old: DataFrame, new: DataFrame) -> DataFrame:
    """W9: one audit row per updated member row (old and new images joined on
    member_id); like the trigger, it does not test that anything changed."""
    o = old.select("member_id", F.col("first_name").alias("_of"), F.col("last_name").alias("_ol"),
                   F.col("status").alias("_os"))
    n = new.select("member_id", F.col("status").alias("_ns"))
    return o.join(n, "member_id").select(
        F.lit("members").alias("table_name"), F.lit("UPDATE").alias("action"),
        F.col("member_id").alias("record_id"), F.lit("SYSTEM").alias("changed_by"),
        F.concat(F.lit(msg.MEMBER_UPDATED_PREFIX), F.col("_of"), F.lit(" "), F.col("_ol"),
                 F.lit(msg.MEMBER_UPDATED_STATUS), F.col("_os"), F.lit(msg.STATUS_ARROW), F.col("_ns"))
        .alias("description"))


def guard_book_delete(book_ids: DataFrame, lib: Library) -> dict[str, DataFrame]:
    """W14: deletes of books with an active loan on any copy are blocked."""
    ids = book_ids.select("book_id")
    busy = (lib.book_copies.select("copy_id", "book_id")
            .join(lib.loans.filter(F.col("status") == "active").select("copy_id"), "copy_id", "left_semi")
            .select("book_id").distinct())
    return {"deletable": ids.join(busy, "book_id", "left_anti"),
            "blocked": ids.join(busy, "book_id", "left_semi").withColumn("reason", F.lit(msg.BOOK_DELETE_BLOCKED))}
