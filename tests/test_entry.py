"""The driver's entry without the training-data subpackage, or without what it needs."""

from __future__ import annotations

import subprocess
import sys
import textwrap

import pytest

from tests.conftest import ROOT

SCRIPT = textwrap.dedent(
    """
    import sys

    class Without:
        def find_spec(self, name, path=None, target=None):
            if name.split(".")[0] == {missing!r} or name == {missing!r}:
                raise ModuleNotFoundError("No module named " + name, name=name)

    sys.meta_path.insert(0, Without())
    sys.path.insert(0, {root!r})
    import __spark_entry__ as entry
    from tremor.plans.registry import QUERIES
    assert set(entry.queries()) == set(entry.oracle_sql()) == set(QUERIES)
    print("ENTRY-OK")
    """
)


@pytest.mark.parametrize("missing", ["tremor.llm", "corpus_pipeline", "tokenizers", "numpy"])
def test_catalog_queries_stay(missing):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(missing=missing, root=str(ROOT))], capture_output=True, text=True, timeout=120)
    assert "ENTRY-OK" in done.stdout, done.stderr[-2000:]
