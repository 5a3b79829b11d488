import subprocess
import sys
from pathlib import Path

BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("tidewire.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
names = set(e.queries())
assert "news_merge_topk" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
assert set(e.oracle_sql()) <= names
"""


def test_entry_stands_without_the_corpus_operators():
    subprocess.run([sys.executable, "-c", BLOCKED], cwd=Path(__file__).parent.parent, check=True)


def test_nothing_else_imports_them():
    root = Path(__file__).parent.parent
    for path in (root / "tidewire").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tidewire.llm" not in path.read_text()
