"""Workers that do not have this repository on their path."""

import os
import subprocess
import sys
import tempfile
import textwrap

import pytest
from conftest import SF0001

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("names", [["op1_language_id", "op4_hmm_scoring"], ["op5_token_planes", "op6_tag_paths", "op11_quality_classifier", "op12_whitening", "op13_collocations"]])
def test_operators_run_where_workers_lack_the_package(names):
    """The driver alone finds the package; models and functions reach the workers by value."""
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from folio.session import build_session
        spark = build_session("local[2]", shuffle_partitions=2)
        def lacks(x):
            try:
                import folio
                return False
            except ModuleNotFoundError:
                return True
        assert all(spark.sparkContext.parallelize(range(2), 2).map(lacks).collect())
        from folio.llm.registry import QUERIES
        for name in {names!r}:
            assert QUERIES[name](spark, {SF0001!r}).count() > 0, name
    """)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(prefix="folio-w-"), env=clean, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
