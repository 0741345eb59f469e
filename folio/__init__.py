"""folio — lending-library analytics as Spark DataFrame jobs.

Layout:
  sources/    driver Parquet readers, library-table derivation, request tables
  functions/  Column-level helpers (names, day counts, exact ratio rounding)
  operators/  reusable relational building blocks that stay scalable under skew
  plans/      the report catalogue (one function per report)
  jobs/       set-based batch jobs for the write-side routines and triggers
  quality/    declared constraints as data-quality jobs
  oracle/     DuckDB SQL used as an independent oracle in tests

Typical use::

    from folio import build_session, library_for, REPORTS
    spark = build_session("local[8]")
    lib = library_for(spark, "/root/testdata/sf0.01")
    REPORTS["q8_3_top3_per_genre"](lib).show()
"""

from folio.config import AS_OF, AS_OF_EVENTS


def __getattr__(name):
    # Lazy exports, so that importing folio does not import pyspark modules early.
    if name == "build_session":
        from folio.session import build_session
        return build_session
    if name == "library_for":
        from folio.sources.catalog import library_for
        return library_for
    if name == "Library":
        from folio.sources.library import Library
        return Library
    if name == "REPORTS":
        from folio.plans.registry import REPORTS
        return REPORTS
    raise AttributeError(name)


__all__ = ["AS_OF", "AS_OF_EVENTS", "build_session", "library_for", "Library", "REPORTS"]
