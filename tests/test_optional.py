import subprocess
import sys

import pytest

LISTED = """
import sys, warnings
for name in {gone}:
    sys.modules[name] = None
warnings.simplefilter("ignore")
import __spark_entry__
print(len(__spark_entry__.queries()), len(__spark_entry__.oracle_sql()), sum(n.startswith("op") for n in __spark_entry__.queries()))
"""


@pytest.mark.parametrize("gone", [["pagelathe.llm"], ["corpus_pipeline"], ["xxhash"], ["zstandard"]])
def test_the_core_stays_without_optional_parts(gone):
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    told = subprocess.run([sys.executable, "-c", LISTED.format(gone=gone)], capture_output=True, text=True, check=True, cwd=__file__.rsplit("/", 2)[0]).stdout
    assert told.split() == [str(len(QUERIES)), str(len(ORACLE)), "0"]
