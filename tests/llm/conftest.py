import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def table_dir(spark, tmp_path):
    """A function that writes texts (or (doc_id, text) pairs) as a documents table and returns its folder."""

    def make(rows, name="documents", schema=SCHEMA):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        if schema is SCHEMA:
            rows = [r if len(r) == 5 else (*r, "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        path = str(tmp_path)
        spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
        return path

    return make
