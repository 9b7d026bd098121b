"""The entry without its optional parts."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
class Broken:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ImportError("no " + name)
sys.meta_path.insert(0, Broken())
import __spark_entry__ as entry
own = entry.queries()
assert set(entry.oracle_sql()) <= set(own)
print(len([n for n in own if n.startswith("op")]), "pipeline" in own, "tfidf_l2" in own)
"""


def run(*names):
    out = subprocess.run([sys.executable, "-c", CODE.format(names=names)], cwd=ROOT, capture_output=True, text=True, check=True)
    return out.stdout.split()


def test_core_queries_survive_any_missing_import():
    for missing in (("ahocorasick",), ("tagwright.llm",), ("tagwright.llm.catalog", "corpus_pipeline")):
        ops, pipeline, core = run(*missing)
        assert (ops, pipeline, core) == ("0", "False", "True")
    assert run("corpus_pipeline")[1:] == ["False", "True"]
