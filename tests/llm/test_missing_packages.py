import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
HIDDEN = """
import sys

class Hide:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)

sys.meta_path.insert(0, Hide())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry

names = set(entry.queries())
assert "route_messages" in names and not any(n.startswith("op1_") for n in names), sorted(names)
assert set(entry.oracle_sql()) <= names
"""


def test_other_queries_survive_a_missing_package():
    """The operators' packages may be missing; the library's own queries need none of them."""
    for name in ("zstandard", "xxhash", "public_tokenizers"):
        done = subprocess.run([sys.executable, "-c", HIDDEN.format(name=name, root=ROOT)], capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
