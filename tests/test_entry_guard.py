"""Without the training-data subpackage everything else imports and is registered."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
sys.modules["keelson.llm"] = None
sys.modules["corpus_pipeline"] = None
import __spark_entry__ as e
names = set(e.queries())
assert len(names) > 100 and set(e.oracle_sql()) <= names, len(names)
assert not any(n.startswith("op") or n == "pipeline" for n in names)
"""


def test_the_rest_works_without_the_llm_subpackage():
    subprocess.run([sys.executable, "-c", CODE], cwd=REPO, check=True, timeout=120)


def test_nothing_else_imports_the_llm_subpackage():
    for folder in ("keelson", "tests"):
        for top, dirs, files in os.walk(os.path.join(REPO, folder)):
            dirs[:] = [d for d in dirs if d not in ("llm", "__pycache__")]
            for name in files:
                if name.endswith(".py") and name != os.path.basename(__file__):
                    with open(os.path.join(top, name), encoding="utf-8") as f:
                        assert "keelson.llm" not in f.read(), name
