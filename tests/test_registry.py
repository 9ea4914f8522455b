"""Every registered query against DuckDB on the smallest tables, when they are there."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_points  # noqa: E402
from registry.inputs import TABLES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}
NO_SQL: set[str] = set()
QUERIES = {name: fn for m in entry_points.LIBRARY for name, fn in m.SPARK.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted(tuple(canonical(r[c]) for c in columns) for r in df.collect())
    if name in NO_SQL:
        assert ours
        return
    result = duck.execute(entry_points.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(types) == columns
    assert {c: TYPES[df.schema[c].dataType.simpleString()] for c in columns} == types
    where = [list(types).index(c) for c in columns]
    theirs = sorted(tuple(canonical(r[i]) for i in where) for r in result.fetchall())
    assert ours == theirs


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[-2:] == ["sku", "confidence"] and not df.isEmpty()


def test_imports_from_a_zip(tmp_path):
    """A driver may have PySpark on its path as an archive, without the folder of jars beside it."""
    import subprocess
    import zipfile

    import pyspark

    package = os.path.dirname(pyspark.__file__)
    archive = tmp_path / "pyspark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith((".py", ".json")):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import pyspark, __spark_entry__ as e; assert '.zip' in pyspark.__file__; print(len(e.queries()), len(e.oracle_sql()))"
    env = os.environ | {"PYTHONPATH": f"{archive}{os.pathsep}{root}"}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("package", ["xxhash", "public_tokenizers", "zstandard", "ahocorasick"])
def test_a_missing_package_of_the_corpus_operators_leaves_the_rest(package):
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"import sys; sys.modules[{package!r}] = None; import __spark_entry__ as e; assert e.LIBRARY == e.MODULES; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout) == len(QUERIES), done.stderr
