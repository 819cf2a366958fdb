"""The entry module keeps the card queries whatever the corpus part lacks."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
found, sql = entry.queries(), entry.oracle_sql()
assert len(found) >= 36 and len(sql) >= 36 and "end_to_end" in found, len(found)
assert not any(name.startswith("op") for name in found) and "pipeline" not in found
"""


@pytest.mark.parametrize("name", ["cardweave.llm", "corpus_pipeline", "xxhash", "tokenizers", "public_tokenizers", "numpy", "pyarrow"])
def test_a_missing_module_costs_the_corpus_queries_only(name):
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", CODE.format(blocked=[name])], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
