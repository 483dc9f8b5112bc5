"""Every query of the catalog against its SQL, on the tables that its check runs on."""

import glob
import os

import duckdb
import pytest

from linkloom.plans import catalog

DATA = "/root/testdata/sf0.01"
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(df):
    names = sorted(df.columns)
    return sorted(map(tuple, df[names].astype(object).where(df[names].notna(), None).astype(str).to_numpy().tolist()))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_registry():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    sql = __spark_entry__.oracle_sql()
    assert set(sql) <= set(__spark_entry__.queries()) and all(isinstance(x, str) for x in sql.values())


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    """A copy without the optional subpackage and the pipeline, and one without the subpackage only."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parent.parent
    for pipeline in (False, True):
        copy = tmp_path / str(pipeline)
        shutil.copytree(top, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "spark-warehouse", *[] if pipeline else ["corpus_pipeline.py"]))
        code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and 'page_link_rollup' in q and not any(k.startswith('op') or k == 'pipeline' for k in q)"
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
