"""The entry without the text operators and their pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_imports_without_text_operators(tmp_path, with_pipeline):
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if with_pipeline else ["corpus_pipeline.py"]))
    copy = shutil.copytree(TOP, tmp_path / "copy", ignore=left_out)
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    number, has_text = done.stdout.split()
    assert int(number) > 90 and has_text == "False"
