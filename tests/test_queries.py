"""Every registered query against its SQL twin on the smallest given tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("SKYFRAME_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given test tables are not here")


@pytest.fixture(scope="module")
def tables():
    import duckdb

    from tools.check import views

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    views(con, FOLDER)
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, tables, name):
    from tools.check import compare

    text = compare(spark, tables, name, entry.queries()[name], entry.oracle_sql().get(name), FOLDER)[1]
    assert "FAIL" not in text, text


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["window_id", "time", "eligible", "missing_observations", "history", "targets"]


@pytest.mark.parametrize("lacking", ["public_tokenizers", "xxhash"])
def test_a_missing_library_of_the_optional_part_leaves_the_rest(lacking):
    """Only queries of the optional part go, and a warning says so."""
    code = (f"import sys; sys.modules[{lacking!r}] = None; import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e;"
            "names = set(e.queries()); assert 'w01_window_eligibility' in names; assert not any(n.startswith('op') or n == 'pipeline' for n in names), names")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=os.path.dirname(os.path.abspath(entry.__file__)))


def test_any_other_import_error_of_the_optional_part_is_an_error():
    code = "import sys; sys.modules['skyframe.session'] = None; import __spark_entry__"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=120, cwd=os.path.dirname(os.path.abspath(entry.__file__))).returncode
