import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(folder / "warehouse")).config("spark.checkpoint.dir", f"file://{folder}/shared").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def same_rows(spark_df, duck, sql):
    """Rows of both, columns by name, compared as sets of text."""
    a, b = spark_df.toPandas(), duck.execute(sql).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)

    def rows(d):
        norm = lambda v: "null" if v is None or v != v else (f"{v:.6g}" if isinstance(v, float) else str(v))
        return sorted(tuple(norm(v) for v in r) for r in d[cols].astype(object).where(d[cols].notna(), None).itertuples(index=False, name=None))

    x, y = rows(a), rows(b)
    float_cols = lambda r: tuple(f"{float(v):.6g}" if v.replace(".", "", 1).replace("-", "", 1).isdigit() and "." in v else v for v in r)
    assert len(x) == len(y)
    assert [float_cols(r) for r in x] == [float_cols(r) for r in y]
