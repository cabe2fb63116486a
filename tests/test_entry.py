"""The driver contract without the optional subpackage."""

import subprocess
import sys

PROBE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {blocked!r} or name in {blocked!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as E
names = list(E.queries())
assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names), names
assert set(E.oracle_sql()) <= set(names)
print(len(names))
"""


def test_other_queries_stand_without_the_subpackage_or_its_libraries():
    counts = set()
    for blocked in (["sentencepiece"], ["public_tokenizers"], ["retainspark.llm"], ["corpus_pipeline"]):
        done = subprocess.run([sys.executable, "-c", PROBE.format(blocked=blocked)], capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        counts.add(int(done.stdout))
    assert len(counts) == 1 and min(counts) >= 85
