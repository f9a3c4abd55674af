"""The entry module without the text subpackage, or without a library only that one needs."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["loomframe.llm", "corpus_pipeline", "ahocorasick"])
def test_entry_without_text_operators(hidden):
    code = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 200 and not any(n.startswith('op') for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
