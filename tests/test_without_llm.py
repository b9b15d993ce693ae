"""The library stands without the training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_subpackage(tmp_path):
    for p in (ROOT / "portico").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            to = tmp_path / p.relative_to(ROOT)
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_text(p.read_text())
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'occupancy_q15' in q and 'pipeline' not in q and not any(n.startswith('op1_') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})
