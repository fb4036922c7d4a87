"""The entry without the libraries of the training-data operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("module", ["public_tokenizers", "zstandard", "corpus_pipeline"])
def test_the_catalogue_is_whole_without(module):
    code = (
        f"import sys, warnings; sys.modules[{module!r}] = None; warnings.simplefilter('ignore'); "
        "import __spark_entry__ as entry; from keytables.plans.catalog import CATALOG; "
        "assert set(entry.queries()) == set(entry.oracle_sql()) == set(CATALOG)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
