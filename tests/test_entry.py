"""The entry, and sessions without any configuration, in processes of their own."""

from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

from scrubline.checks import QUERIES

ROOT = Path(__file__).resolve().parent.parent


def run(code: str, **env: str) -> str:
    done = subprocess.run(
        [sys.executable, "-c", code],
        cwd=ROOT,
        env=os.environ | env,
        capture_output=True,
        text=True,
        timeout=300,
        check=False,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.strip()


@pytest.mark.parametrize("missing", ["scrubline.llm", "scrubline.llm.queries", "corpus_pipeline"])
def test_entry_without_the_optional_part(missing):
    code = f"import sys; sys.modules['{missing}'] = None\nimport __spark_entry__ as e\n"
    assert run(code + "print(len(e.queries()), len(e.oracle_sql()))") == f"{len(QUERIES)} {len(QUERIES)}"


def test_session_without_a_checkpoint_folder(tmp_path):
    """Written intermediate tables work in a plain local session."""
    code = """
from scrubline.checks import QUERIES
from scrubline.session import build_session, shared_folder
spark = build_session("plain", master="local[2]", spark__ui__showConsoleProgress="false")
assert spark.conf.get("spark.checkpoint.dir", None) is None
one, other = shared_folder(spark, "a"), shared_folder(spark, "a")
assert one != other
assert one.split("/scrubline/")[0] == other.split("/scrubline/")[0]
print(QUERIES["csv_roundtrip"](spark, "/root/testdata/sf0.001").count() > 0)
"""
    conf = tmp_path / "conf"
    conf.mkdir()
    assert run(code, SPARK_CONF_DIR=str(conf), TMPDIR=str(tmp_path)) == "True"


def test_names_of_test_files_differ():
    names = Counter(p.name for p in (ROOT / "tests").rglob("test_*.py"))
    assert max(names.values()) == 1
