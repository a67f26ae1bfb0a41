"""Scopes and the entry module."""

import os
import subprocess
import sys
import threading
from pathlib import Path

from riskloom.session import scope, work_path, written

ROOT = Path(__file__).resolve().parents[1]


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scopes_that_overlap_in_time_keep_their_own_tables(spark):
    made, go, done = {}, threading.Event(), threading.Event()

    def other():
        with scope(spark):
            made["b"] = folder(written(spark.range(3), "b"))
            go.set()
            done.wait(60)
            made["b stays"] = os.path.exists(made["b"])

    thread = threading.Thread(target=other)
    with scope(spark):
        thread.start()
        assert go.wait(60)
        made["a"] = folder(written(spark.range(2), "a"))
    assert not os.path.exists(made["a"])
    done.set()
    thread.join()
    assert made["b stays"] and not os.path.exists(made["b"])


def test_scopes_closed_out_of_order(spark):
    first, second = scope(spark), scope(spark)
    first.__enter__()
    a = folder(written(spark.range(2), "a"))
    second.__enter__()
    b = folder(written(spark.range(2), "b"))
    first.__exit__(None, None, None)
    assert not os.path.exists(a) and os.path.exists(b)
    second.__exit__(None, None, None)
    assert not os.path.exists(b)


def test_entry_without_an_optional_library():
    """A library that only the corpus operators need may be missing."""
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 90 and out[1] == "False"
