"""The training-data subpackage can be taken away."""

import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "pulsegrid").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"pulsegrid\.llm|from pulsegrid import llm", path.read_text()), path


def test_entry_stands_without_it(tmp_path):
    (tmp_path / "pulsegrid").mkdir()
    for p in (ROOT / "pulsegrid").iterdir():
        if p.name != "llm":
            (tmp_path / "pulsegrid" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rank_portfolio' in q and not any(x.startswith('op') or x == 'pipeline' for x in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, timeout=120)
