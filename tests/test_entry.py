"""The entry point works with and without the optional pipeline operators."""

import subprocess
import sys

CODE = """
import sys
for name in {blocked}:
    sys.modules[name] = None
import __spark_entry__ as entry
names = entry.queries()
print(len(names), sum(n.startswith("op") or n == "pipeline" for n in names), set(entry.oracle_sql()) <= set(names))
"""


def run(*blocked):
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(blocked=list(blocked))], capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    total, optional, known = done.stdout.split()
    return int(total), int(optional), known


def test_the_rest_stands_alone():
    total, optional, known = run("sipnote.llm", "corpus_pipeline")
    assert total >= 55 and optional == 0 and known == "True"
