import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

D = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
def test_queries_against_sql(spark):
    import duckdb

    import __spark_entry__ as entry
    from rollmill import plans

    con = duckdb.connect()
    for name in os.listdir(D):
        con.execute(f"create view {name.split('.')[0]} as select * from '{D}/{name}'")
    for name, sql in plans.oracle_sql().items():
        got = plans.queries()[name](spark, D)
        cursor = con.execute(sql)
        columns = [c[0] for c in cursor.description]
        assert sorted(got.columns) == sorted(columns), name
        norm = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
        have = sorted(repr([norm(r[c]) for c in sorted(columns)]) for r in got.collect())
        want = sorted(repr([norm(r[columns.index(c)]) for c in sorted(columns)]) for r in cursor.fetchall())
        assert have == want, (name, [x for x in have if x not in want][:3], [x for x in want if x not in have][:3])
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("foreign", [False, True])
@pytest.mark.parametrize("gone", [["rollmill/llm", "tests/llm"], ["rollmill/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_without_the_training_data_part(tmp_path, gone, foreign):
    """The registry in a copy of the repository that lacks these folders, with and without a whole copy on the import path."""
    root = Path(__file__).resolve().parents[1]
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json"))
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
            (path / "__pycache__").mkdir(parents=True)  # what an import may have left
        elif path.exists():
            path.unlink()
    code = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q, any(k.startswith('op1_') for k in q), callable(e.entry))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | ({"PYTHONPATH": str(root)} if foreign else {})
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, pipeline, op1, entry = done.stdout.split()
    assert int(n) >= 40 and pipeline == "False" and entry == "True"
    assert op1 == str("rollmill/llm" not in gone and (root / "rollmill/llm/queries.py").exists())
