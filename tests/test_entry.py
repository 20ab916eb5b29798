"""The entry without the optional part: folder gone, folder empty, a library missing."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.queries()) - set(e.QUERIES)), len(e.oracle_sql()))"


@pytest.mark.parametrize("case", ["gone", "empty", "library"])
def test_the_engine_stands_alone(tmp_path, case):
    for name in ("ledgermill", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm" if case != "library" else "-"))
        elif source.exists() and (case != "gone" or name != "corpus_pipeline.py"):
            shutil.copy(source, tmp_path / name)
    if case == "empty":
        (tmp_path / "ledgermill" / "llm" / "__pycache__").mkdir(parents=True)
    block = "import sys; sys.modules['ahocorasick'] = None; " if case == "library" else ""
    out = subprocess.run([sys.executable, "-c", block + ASK], cwd=tmp_path, capture_output=True, text=True, check=True, env={"PYTHONPATH": str(tmp_path)})
    from ledgermill.catalogue.queries import QUERIES
    assert out.stdout.split("\n")[0] == f"{len(QUERIES)} [] {len(QUERIES)}"
