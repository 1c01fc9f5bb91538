"""The entry module without the operators for training data, or without what they import."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.partition(".")[0] in {hidden!r} or name in {hidden!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), sorted(n for n in e.queries() if n.startswith("op") and n[2].isdigit()))
"""


def run(*hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_core_queries_do_not_need_the_other_ones():
    from sluiceway.queries import QUERIES

    for hidden in (["public_tokenizers"], ["sluiceway.llm", "corpus_pipeline"]):
        assert run(*hidden) == f"{len(QUERIES)} {len(QUERIES)} []", hidden
