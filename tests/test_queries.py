"""Every registered query against its SQL counterpart on the smallest tables."""

import importlib.util
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
#: The optional pipeline operators are tested with them.
NAMES = sorted(n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n))
spec = importlib.util.spec_from_file_location("compare", Path(__file__).parent.parent / "scripts" / "compare.py")
compare = importlib.util.module_from_spec(spec)
spec.loader.exec_module(compare)


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare.compare(spark, con, FOLDER, name).startswith(("equal", "rows only"))


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_every_query_has_sql():
    assert not set(NAMES) - set(entry.oracle_sql())
    assert not set(entry.oracle_sql()) - set(entry.queries())
