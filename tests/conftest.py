import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from folio.session import build_session
    from folio.sources import catalog

    session = build_session("local[4]", app_name="folio-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    # Stored library tables of this test run go to a fresh folder.
    catalog.set_root(tempfile.mkdtemp(prefix="folio-test-lib-"))
    yield session


@pytest.fixture(scope="session")
def sf0001_lib(spark):
    from folio.sources.catalog import library_for

    return library_for(spark, SF0001)


def rows(df, *cols):
    """Collected rows as plain tuples (all columns, or the named ones)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
