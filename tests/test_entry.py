"""What the driver calls, with and without the subpackage that can be taken out."""

import os
import subprocess
import sys

import __spark_entry__
from quaywatch import queries
from quaywatch.settings import Settings

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WITHOUT = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "corpus_pipeline" or name.startswith("quaywatch.llm"):
            raise ModuleNotFoundError(name, name=".".join(name.split(".")[:2]))

sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(*sorted(e.queries()))
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_without_the_subpackage():
    out = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": ROOT})
    assert out.stdout.split() == sorted(queries.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "quaywatch")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "quaywatch.llm" not in f.read(), name


def test_settings():
    s = Settings.load({"QUAYWATCH_WINDOW_S": "30", "QUAYWATCH_BRONZE": "b", "OTHER": "x"})
    assert (s.window_s, s.bronze, s.replay_speed) == (30, "b", 60.0)
