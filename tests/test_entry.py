"""The driver contract holds without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

CODE = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("tillflow.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert len(q) > 100 and set(o) <= set(q)
assert not [k for k in q if k == "pipeline" or k[:2] == "op" and k[2].isdigit()]
"""


def test_entry_without_the_optional_operators():
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", CODE], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_only_one_process_masters_get_a_local_folder():
    from tillflow.session import one_process
    assert all(map(one_process, ("local", "local[8]", "local[*]", "local[4,2]")))
    assert not any(map(one_process, ("local-cluster[2,1,1024]", "spark://h:7077", "yarn", "k8s://local")))
