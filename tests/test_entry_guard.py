"""The entry point stands without its optional part, and hides no other import error."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def run(code: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_without_the_optional_part():
    for missing in ("corpus_pipeline", "lakeloom.llm", "lakeloom.llm.queries"):
        out = run(f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), "
                  "any(n.startswith('op') for n in e.queries()))")
        assert out.returncode == 0, out.stderr
        queries, twins, found = out.stdout.split()
        assert int(queries) > 200 and int(twins) > 200 and found == "False"


def test_other_import_errors_are_not_hidden():
    found = run("import importlib.util as u; print(bool(u.find_spec('lakeloom.llm') and u.find_spec('corpus_pipeline')))")
    if "True" in found.stdout:
        out = run("import sys; sys.modules['xxhash'] = None; import __spark_entry__")
        assert out.returncode != 0 and "xxhash" in out.stderr
