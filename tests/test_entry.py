"""The contract of the entry module: names pair up, SQL twins agree, the core stands alone."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from adlens.plans import catalogue

REPO = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.queries()) <= set(entry.queries())


def test_the_core_imports_without_llm():
    code = "import sys; sys.modules['adlens.llm'] = None; import __spark_entry__ as e; n = e.queries(); assert 'p4_found' in n and 'p1_found' not in n"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=REPO, env=os.environ | {"PYTHONPATH": str(REPO)})


def canon(rows, columns):
    def c(v):
        if v is None or v != v:
            return "N"
        if isinstance(v, float):
            return f"{v:.6g}"
        return str(v)

    return sorted("|".join(c(r[k]) for k in sorted(columns)) for r in rows)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_sql_twins(spark):
    import duckdb

    con = duckdb.connect()
    for f in DATA.iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    wrong = []
    for name, sql in catalogue.oracle_sql().items():
        rows = [r.asDict() for r in catalogue.queries()[name](spark, str(DATA)).collect()]
        cur = con.execute(sql)
        columns = [d[0] for d in cur.description]
        want = [dict(zip(columns, r)) for r in cur.fetchall()]
        if (rows and set(rows[0]) != set(columns)) or canon(rows, columns) != canon(want, columns):
            wrong.append(name)
    assert not wrong


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
