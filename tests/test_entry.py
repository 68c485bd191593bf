"""The driver's entry with and without the document operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(blocked: str) -> set[str]:
    """Registered queries where importing ``blocked`` fails."""
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r}); sys.modules[{blocked!r}] = None\n"
        "import __spark_entry__ as e\nassert set(e.oracle_sql()) <= set(e.queries())\nprint(*e.queries())"
    )
    return set(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())


def test_the_other_queries_stay_where_the_document_operators_cannot_be_imported():
    from marketide.plans.registry import REGISTRY

    for blocked in ("public_tokenizers", "marketide.llm"):
        assert names(blocked) == set(REGISTRY)
