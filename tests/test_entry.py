import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDDEN = """
import sys

class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "public_tokenizers":
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
assert "purge" in entry.queries() and "purge" in entry.oracle_sql()
assert not [name for name in entry.queries() if name.startswith("op") or name == "pipeline"]
"""


def test_the_entry_works_without_the_corpus_operators():
    done = subprocess.run([sys.executable, "-c", HIDDEN], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
