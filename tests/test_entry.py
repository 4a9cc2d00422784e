import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def keys(*hidden):
    """Query keys of the entry point where some modules can't be imported."""
    code = f"import sys\nfor m in {hidden!r}: sys.modules[m] = None\nimport __spark_entry__ as e\nprint(*sorted(e.queries()))\nassert set(e.oracle_sql()) <= set(e.queries())"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()


def test_entry_works_without_the_text_operators_or_what_they_need():
    rates = keys("ratelake.llm", "corpus_pipeline")
    assert len(rates) > 80 and not [k for k in rates if k.startswith("op") or k == "pipeline"]
    assert keys("zstandard") == rates == keys("ratelake.llm.queries", "corpus_pipeline")
