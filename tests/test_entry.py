"""The entry works without the training-data operators, for whatever reason
they cannot be imported."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

NAMES = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def names(cwd, before=""):
    out = subprocess.run([sys.executable, "-c", before + NAMES], cwd=cwd, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": str(cwd), "PYTHONDONTWRITEBYTECODE": "1"})
    assert out.returncode == 0, out.stderr
    return [line.split() for line in out.stdout.splitlines()]


def base_only(queries, oracles):
    assert len(queries) >= 21 and set(oracles) == set(queries)
    assert not any(q.startswith("op") or q == "pipeline" for q in queries)


@pytest.mark.parametrize("missing", ["sentencepiece", "public_tokenizers", "rivulet.llm"])
def test_a_library_cannot_be_imported(missing):
    base_only(*names(ROOT, f"import sys; sys.modules[{missing!r}] = None; "))


@pytest.mark.parametrize("left", [False, True])
def test_the_folders_are_deleted(tmp_path, left):
    for name in ("rivulet", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    if left:  # what a deleted folder may leave
        (tmp_path / "rivulet/llm/__pycache__").mkdir(parents=True)
    base_only(*names(tmp_path))
