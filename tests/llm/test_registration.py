import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract
from precedent.llm.queries import QUERIES
from precedent.llm.sql import ORACLE

ROOT = Path(__file__).resolve().parents[2]


def test_every_operator_has_one_query():
    assert [int(name.split("_")[0][2:]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


def test_a_missing_package_leaves_the_other_queries():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as c;"
        "names = set(c.queries()); assert 'resolve_batch' in names and 'pipeline' not in names, names;"
        "assert not any(n.startswith('op') for n in names); assert set(c.oracle_sql()) <= names"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
