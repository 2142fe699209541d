import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rankspark.operators import index as ix  # noqa: E402
from rankspark.session import fresh_folder  # noqa: E402

MICRO = [
    (1, "apple banana apple cherry"),
    (2, "banana cherry banana"),
    (3, "date apple"),
    (4, "cherry date date elder"),
]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rankspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", "file:" + tempfile.mkdtemp(prefix="rankspark-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """The four-document collection, written and opened."""
    docs = spark.createDataFrame(MICRO, "doc_id BIGINT, text STRING")
    return ix.write_index(docs, fresh_folder(spark, "micro"), buckets=3)


def rows(df):
    """Rows without the numbers of copies, which are 0 where keys are unique."""
    df = df.drop("copy_no", "seed_copy")
    return [tuple(r) for r in df.collect()]
