"""Nothing outside the subpackage of training-data operators needs it."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_imports_it():
    for p in (ROOT / "siftwright").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"siftwright[. ]+(?:import )?llm", p.read_text()), p


def test_entry_without_it(tmp_path):
    for name in ("siftwright", "__spark_entry__.py"):
        s = ROOT / name
        (shutil.copytree if s.is_dir() else shutil.copy)(s, tmp_path / name)
    shutil.rmtree(tmp_path / "siftwright" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; assert not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']; assert 'report_region_month' in e.queries(); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_the_rest_without_both_folders(tmp_path):
    """The rest's tests can all be collected, and those that need no session of Spark's pass."""
    for name in ("siftwright", "tests", "__spark_entry__.py", "bench.py"):
        s = ROOT / name
        (shutil.copytree if s.is_dir() else shutil.copy)(s, tmp_path / name)
    shutil.rmtree(tmp_path / "siftwright" / "llm")
    shutil.rmtree(tmp_path / "tests" / "llm")
    run = lambda *a: subprocess.run([sys.executable, "-m", "pytest", "-q", "-p", "no:cacheprovider", *a], cwd=tmp_path, check=True)
    run("--collect-only", "tests")
    run("tests/test_engine.py", "-k", "masks or contracts or paths or policy or retention")


def test_entry_where_a_library_is_missing(tmp_path):
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert 'report_region_month' in q and 'op2_simhash' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, check=True)
