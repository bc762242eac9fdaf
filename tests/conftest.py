import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    place = tmp_path_factory.mktemp("shared")
    made = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", f"file://{place}")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def oracle(sf_dir):
    """Runs SQL in DuckDB on the tables of ``sf_dir``: sorted rows with columns by name."""
    import duckdb

    db = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")

    def run(sql: str):
        found = db.execute(sql)
        names = [d[0] for d in found.description]
        at = [names.index(n) for n in sorted(names)]
        return sorted(names), sorted((tuple(r[k] for k in at) for r in found.fetchall()), key=repr)

    return run


@pytest.fixture(scope="session")
def rows_of():
    def run(df):
        names = sorted(df.columns)
        return names, sorted((tuple(r) for r in df.select(*names).collect()), key=repr)

    return run
