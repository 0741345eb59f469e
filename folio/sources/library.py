"""The nine library tables.

``Library`` bundles one DataFrame per table. It can be built three ways:

* ``Library.from_driver(spark, sf_dir)`` derives the tables from the driver's
  star schema with integer arithmetic only (the recipe of FIXTURES.md), so the
  DuckDB oracle can derive identical rows;
* ``Library.from_parquet(spark, path)`` reads stored library tables (the
  production layout: one Parquet folder per table);
* ``Library.from_frames(...)`` wraps DataFrames built in tests.

Everything is lazy: building a Library runs no job.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources.driver import read_driver

LIBRARY_SCHEMAS: dict[str, T.StructType] = {
    "authors": T.StructType([
        T.StructField("author_id", T.LongType(), False),
        T.StructField("author_name", T.StringType(), False),
        T.StructField("birth_year", T.LongType()),
        T.StructField("country", T.StringType()),
    ]),
    "members": T.StructType([
        T.StructField("member_id", T.LongType(), False),
        T.StructField("first_name", T.StringType(), False),
        T.StructField("last_name", T.StringType(), False),
        T.StructField("email", T.StringType(), False),
        T.StructField("phone", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("join_date", T.DateType()),
        T.StructField("membership_type", T.StringType()),
        T.StructField("status", T.StringType()),
    ]),
    "lib_events": T.StructType([
        T.StructField("event_id", T.LongType(), False),
        T.StructField("event_name", T.StringType(), False),
        T.StructField("event_date", T.DateType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("max_attendees", T.IntegerType()),
    ]),
    "audit_log": T.StructType([
        T.StructField("log_id", T.LongType(), False),
        T.StructField("table_name", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("changed_at", T.TimestampType()),
        T.StructField("changed_by", T.StringType()),
        T.StructField("description", T.StringType()),
    ]),
    "books": T.StructType([
        T.StructField("book_id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("author_id", T.LongType(), False),
        T.StructField("isbn", T.StringType(), False),
        T.StructField("publication_year", T.IntegerType()),
        T.StructField("genre", T.StringType(), False),
        T.StructField("total_copies", T.IntegerType()),
    ]),
    "book_copies": T.StructType([
        T.StructField("copy_id", T.LongType(), False),
        T.StructField("book_id", T.LongType(), False),
        T.StructField("copy_number", T.IntegerType(), False),
        T.StructField("condition_status", T.StringType()),
        T.StructField("acquisition_date", T.DateType()),
    ]),
    "loans": T.StructType([
        T.StructField("loan_id", T.LongType(), False),
        T.StructField("member_id", T.LongType(), False),
        T.StructField("copy_id", T.LongType(), False),
        T.StructField("loan_date", T.DateType(), False),
        T.StructField("due_date", T.DateType(), False),
        T.StructField("return_date", T.DateType()),
        T.StructField("status", T.StringType()),
    ]),
    "fines": T.StructType([
        T.StructField("fine_id", T.LongType(), False),
        T.StructField("loan_id", T.LongType(), False),
        T.StructField("fine_amount", T.DecimalType(10, 2), False),
        T.StructField("fine_reason", T.StringType(), False),
        T.StructField("paid", T.BooleanType()),
        T.StructField("payment_date", T.DateType()),
    ]),
    "event_registrations": T.StructType([
        T.StructField("registration_id", T.LongType(), False),
        T.StructField("event_id", T.LongType(), False),
        T.StructField("member_id", T.LongType(), False),
        T.StructField("registration_date", T.DateType()),
    ]),
}

TABLES = ("authors", "members", "lib_events", "audit_log", "books", "book_copies",
          "loans", "fines", "event_registrations")

# The status codes and the click-stream event types of the driver
# tables, mapped to the library's ENUM values (FIXTURES.md §1).
ORDER_STATUS_TO_LOAN_STATUS = {"O": "active", "F": "returned", "P": "lost"}
CLICK_TYPE_INDEX = {"click": 1, "view": 2, "purchase": 3, "signup": 4, "error": 5}
EVENT_TYPE_BY_INDEX = {1: "book_club", 2: "workshop", 3: "reading_program",
                       4: "author_visit", 5: "workshop", 6: "workshop"}
CONDITION_BY_INDEX = {0: "excellent", 1: "good", 2: "fair", 3: "poor"}
FINE_REASON_BY_REMAINDER = {0: "overdue", 3: "damage"}   # loan_id % 9; others 'lost'
EVENT_WEEK_ORIGIN = _dt.date(2024, 1, 1)
JOIN_DATE_ORIGIN = _dt.date(1995, 1, 1)
ACQUISITION_ORIGIN = _dt.date(1994, 1, 1)


# Layout of stored library tables: the Spark counterpart of the reference's
# secondary indexes (report group 11). Rows are sorted inside each file by the
# indexed columns, so Parquet min/max statistics let filtered scans skip row
# groups; joins and aggregates are left to the planner.
LAYOUT = {
    "loans": ["status", "due_date", "member_id"],
    "fines": ["paid", "loan_id"],
    "books": ["genre", "book_id"],
    "book_copies": ["book_id", "copy_id"],
    "lib_events": ["event_date"],
    "event_registrations": ["event_id", "member_id"],
    "members": ["member_id"],
}
LAYOUT_VERSION = "layout-3"


def _case(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(col == F.lit(key), F.lit(value)) if out is None else out.when(col == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def _plus_days(date_col: Column, days: Column) -> Column:
    return F.date_add(date_col, days.cast("int"))


class Library:
    """One DataFrame per library table; tables are created on first use."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        missing = [t for t in TABLES if t not in tables]
        if missing:
            raise ValueError(f"missing library tables: {missing}")
        self._sources = dict(tables)
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            src = self._sources[name]
            self._frames[name] = src() if callable(src) else src
        return self._frames[name]

    authors = property(lambda self: self.table("authors"))
    members = property(lambda self: self.table("members"))
    lib_events = property(lambda self: self.table("lib_events"))
    audit_log = property(lambda self: self.table("audit_log"))
    books = property(lambda self: self.table("books"))
    book_copies = property(lambda self: self.table("book_copies"))
    loans = property(lambda self: self.table("loans"))
    fines = property(lambda self: self.table("fines"))
    event_registrations = property(lambda self: self.table("event_registrations"))

    # ------------------------------------------------------------------ builders
    @classmethod
    def from_frames(cls, spark: SparkSession, **frames: DataFrame) -> "Library":
        """Tables given as DataFrames; missing ones are empty with the right schema."""
        empty = {name: (lambda n=name: spark.createDataFrame([], LIBRARY_SCHEMAS[n])) for name in TABLES
                 if name not in frames}
        return cls({**empty, **frames})

    @classmethod
    def from_rows(cls, spark: SparkSession, **rows: list) -> "Library":
        """Tables given as lists of tuples in the column order of LIBRARY_SCHEMAS."""
        frames = {name: spark.createDataFrame(data, LIBRARY_SCHEMAS[name]) for name, data in rows.items()}
        return cls.from_frames(spark, **frames)

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str) -> "Library":
        """Stored library tables, one Parquet folder per table under ``path``."""
        base = path.rstrip("/")

        def reader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.schema(LIBRARY_SCHEMAS[name]).parquet(f"{base}/{name}")
        return cls({name: reader(name) for name in TABLES})

    def register_views(self, prefix: str = "") -> None:
        """Expose the tables as temporary views (``members``, ``loans``, ...)
        so reports can also be written as Spark SQL text."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")

    def write_parquet(self, path: str, mode: str = "overwrite", parallel: int = 6,
                      names: Sequence[str] = TABLES) -> None:
        """Store tables under ``path`` (sorted per LAYOUT). Tables are
        independent jobs, submitted from a few threads so small tables do not
        wait for each other."""
        base = path.rstrip("/")

        def write(name: str) -> None:
            df = self.table(name)
            if LAYOUT.get(name):
                df = df.sortWithinPartitions(*LAYOUT[name])
            if name == "audit_log":
                df = df.coalesce(1)
            df.write.mode(mode).parquet(f"{base}/{name}")

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            list(pool.map(write, names))

    @classmethod
    def store_from_driver(cls, spark: SparkSession, sf_dir: str, path: str) -> None:
        """Derive and write all tables in dependency waves: tables built on
        books and loans read the written copies, so the orders-parts join
        behind loans runs once and lineage is cut after each wave."""
        base = path.rstrip("/")

        def read(name: str) -> DataFrame:
            return spark.read.schema(LIBRARY_SCHEMAS[name]).parquet(f"{base}/{name}")

        cls.from_driver(spark, sf_dir).write_parquet(
            base, names=["books", "authors", "members", "lib_events", "event_registrations", "audit_log"])
        cls.from_driver(spark, sf_dir, stored={"books": read("books")}).write_parquet(
            base, names=["loans", "book_copies"])
        cls.from_driver(spark, sf_dir, stored={"books": read("books"), "loans": read("loans")}).write_parquet(
            base, names=["fines"])

    # ------------------------------------------------------------- derivation
    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, stored: Mapping[str, DataFrame] | None = None
                    ) -> "Library":
        """Derive the library tables from the driver's star schema (FIXTURES.md).

        ``stored`` may hold already written tables (books, loans): tables
        derived from them read the written copy instead of re-deriving it.
        """
        stored = dict(stored or {})

        def rd(name: str) -> DataFrame:
            return read_driver(spark, sf_dir, name)

        supplier, nation, customer = rd("supplier"), rd("nation"), rd("customer")
        part, orders, clicks = rd("part"), rd("orders"), rd("events")

        # Table sizes used as moduli: one-row scalar subqueries, evaluated once.
        n_suppliers = supplier.select(F.count(F.lit(1))).scalar()
        n_parts = part.select(F.count(F.lit(1))).scalar()

        authors = (
            supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
            .select(F.col("s_suppkey").alias("author_id"),
                    F.col("s_name").alias("author_name"),
                    (F.lit(1900) + F.col("s_suppkey") % 90).alias("birth_year"),
                    F.col("n_name").alias("country"))
        )

        ck = F.col("c_custkey")
        members = customer.select(
            ck.alias("member_id"),
            F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.when(ck % 7 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("+1-"), ck.cast("string"))).alias("phone"),
            F.when(ck % 11 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("ADDR-"), (ck - ck % 3).cast("string"))).alias("address"),
            _plus_days(F.lit(JOIN_DATE_ORIGIN), (ck * 37) % 2400).alias("join_date"),
            F.when(ck % 10 < 5, "standard").when(ck % 10 < 8, "premium")
             .otherwise("student").alias("membership_type"),
            F.when(ck % 13 == 0, "suspended").when(ck % 13 == 1, "expired")
             .otherwise("active").alias("status"),
        )

        pk = F.col("p_partkey")
        books = part.select(
            pk.alias("book_id"),
            F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("title"),
            (pk % n_suppliers).alias("author_id"),
            F.concat(F.lit("978"), F.lpad(pk.cast("string"), 10, "0")).alias("isbn"),
            (F.lit(1961) + F.col("p_size")).alias("publication_year"),
            F.col("p_type").alias("genre"),
            (F.lit(1) + F.col("p_size") % 4).alias("total_copies"),
        )

        books = stored.get("books", books)
        copy_no = F.col("copy_number")
        book_copies = (
            books.select("book_id", F.explode(F.sequence(F.lit(1), F.col("total_copies"))).alias("copy_number"))
            .select(
                (F.col("book_id") * 10 + copy_no).alias("copy_id"),
                "book_id",
                copy_no,
                _case((F.col("book_id") + copy_no) % 4, CONDITION_BY_INDEX).alias("condition_status"),
                _plus_days(F.lit(ACQUISITION_ORIGIN), (F.col("book_id") * 7 + copy_no) % 365)
                .alias("acquisition_date"),
            )
        )

        ok = F.col("o_orderkey")
        # Each 17th customer's orders go to the one before, so that some members have no loan.
        ck = F.col("o_custkey")
        lender = F.when(ck % 17 != 0, ck).when(ck == 0, ck + 1).otherwise(ck - 1)
        pick = (ok * 31) % n_parts
        lent = (
            orders.select("o_orderkey", lender.alias("o_custkey"), "o_orderstatus", "o_orderdate",
                    F.when(pick % 10 == 9, pick - 1).otherwise(pick).alias("lent_book"))
        )
        loan_date = F.to_date("o_orderdate")
        loans = (
            lent.join(books.select(F.col("book_id").alias("lent_book"), "total_copies"), "lent_book")
            .select(
                ok.alias("loan_id"),
                F.col("o_custkey").alias("member_id"),
                (F.col("lent_book") * 10 + 1 + ok % F.col("total_copies")).alias("copy_id"),
                loan_date.alias("loan_date"),
                F.date_add(loan_date, 14).alias("due_date"),
                F.when(F.col("o_orderstatus") == "F", _plus_days(loan_date, 1 + ok % 25)).alias("return_date"),
                _case(F.col("o_orderstatus"), ORDER_STATUS_TO_LOAN_STATUS).alias("status"),
            )
        )

        loans = stored.get("loans", loans)
        lid = F.col("loan_id")

        def fine_rows(selector: Column, fine_id: Column, paid: Column) -> DataFrame:
            return loans.filter(selector).select(
                fine_id.alias("fine_id"),
                lid,
                ((lid * 53 % 12000) * F.lit(Decimal("0.01"))).cast("decimal(10,2)").alias("fine_amount"),
                _case(lid % 9, FINE_REASON_BY_REMAINDER, "lost").alias("fine_reason"),
                paid.alias("paid"),
                F.when(paid & (lid % 50 != 0), F.date_add("loan_date", 30)).alias("payment_date"),
            )

        fines = fine_rows(lid % 3 == 0, lid * 2, lid % 2 == 0).unionByName(
            fine_rows((lid % 12 == 0) | (lid % 12 == 3), lid * 2 + 1, lid % 2 == 1))

        # A click type outside the known ones keeps its rows; its event type then fails the domain rule.
        ti = F.coalesce(_case(F.col("event_type"), CLICK_TYPE_INDEX), F.lit(0))
        week = F.trunc(F.to_date("ts"), "week")
        clicks_w = clicks.select(
            ti.alias("ti"), F.col("event_type").alias("click_type"), week.alias("wk"),
            F.datediff(week, F.lit(EVENT_WEEK_ORIGIN)).cast("long").alias("wd"),
            "user_id", "ts",
        )
        # Besides, each week has an open day that needs no registration.
        open_days = clicks_w.select(F.lit(6).alias("ti"), F.lit("open day").alias("click_type"), "wk", "wd")

        ev_id = F.col("wd") * 10 + F.col("ti")
        lib_events = (
            clicks_w.select("ti", "click_type", "wk", "wd").unionByName(open_days).distinct()
            .select(
                ev_id.alias("event_id"),
                F.concat(F.col("click_type"), F.lit(" "), F.col("wk").cast("string")).alias("event_name"),
                F.date_add("wk", F.col("ti")).alias("event_date"),
                F.coalesce(_case(F.col("ti"), EVENT_TYPE_BY_INDEX), F.col("click_type")).alias("event_type"),
                F.when(F.col("ti") == 4, F.lit(None).cast("int"))
                 .otherwise(F.lit(50) + F.col("ti") * 20).alias("max_attendees"),
            )
        )

        event_registrations = (
            clicks_w.groupBy("wd", "ti", "user_id").agg(F.min("ts").alias("first_ts"))
            .select(
                (ev_id * 1_000_000_000_000 + F.col("user_id")).alias("registration_id"),
                ev_id.alias("event_id"),
                F.col("user_id").alias("member_id"),
                F.to_date("first_ts").alias("registration_date"),
            )
        )

        audit_log = spark.createDataFrame([], LIBRARY_SCHEMAS["audit_log"]).coalesce(1)

        return cls({"authors": authors, "members": members, "lib_events": lib_events, "audit_log": audit_log,
                    "books": books, "book_copies": book_copies, "loans": loans, "fines": fines,
                    "event_registrations": event_registrations})
