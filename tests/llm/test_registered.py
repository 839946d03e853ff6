import ast
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from celltide.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
REPO = Path(__spark_entry__.__file__).parent


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "benchmark"):
        con.execute(f"create view {view} as select * from '{SF}/{view}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in places)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


def test_nothing_else_imports_these_operators():
    for path in (REPO / "celltide").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [
                node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names), path


def test_entry_works_without_the_folder(tmp_path):
    """As if the folder and the pipeline were gone: their import fails as it then would."""
    code = (
        "import sys\n"
        f"sys.path.insert(0, {str(REPO)!r})\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('celltide.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and not any(k.startswith('op') for k in e.queries())\n"
        "assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_operators_do_not_swallow_import_errors():
    for path in [*(REPO / "celltide/llm").glob("*.py"), REPO / "corpus_pipeline.py"]:
        text = path.read_text()
        assert "except ImportError" not in text and "except ModuleNotFoundError" not in text
        assert "localCheckpoint" not in text
