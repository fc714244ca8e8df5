"""The driver's entry module with and without the optional corpus operators."""

import os
import subprocess
import sys

import __spark_entry__
from supplyloom.queries.catalog import QUERIES, SQL

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


def test_every_query_of_the_reports_is_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(SQL) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_a_missing_library_costs_the_corpus_operators_only(tmp_path):
    code = f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
