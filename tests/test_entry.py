"""The driver contract, also in a copy of the tree without the training-data operators."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def _counts(folder) -> list[str]:
    done = subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def _copy(folder, *left_out):
    shutil.copytree(ROOT / "ledgerline", folder / "ledgerline", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out:
            shutil.copy(ROOT / name, folder / name)
    return folder


def test_entry_without_the_training_data_operators(tmp_path):
    from ledgerline.plans import catalog

    catalog.load_all()
    own = [str(len(catalog.QUERIES)), str(len(catalog.ORACLES)), "False"]
    assert _counts(_copy(tmp_path / "neither", "llm", "corpus_pipeline.py")) == own
    assert _counts(_copy(tmp_path / "pipeline-left", "llm")) == own
