from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

MESSY = """ Item Id,Grade,Score (pct),Kind,Code,Flag
1,A,10.0, red ,7,0
2,B,,blue,?,1
3,,30.0,red,9,0
4,B,40.0,NA,7,0
5,A,50.0,blue,7,1
6,?,60.0,red,8,0
7,B,,blue,7,0
8,A,80.0,green,9,1
8,A,80.0,green,9,1
9,B,1000.0,red,7,0
10,A,20.0,blue,7,0
11,B,35.0,red,8,0
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tabloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def messy_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("messy") / "messy.csv"
    path.write_text(MESSY)
    return str(path)


@pytest.fixture(scope="session")
def cleaned(spark, messy_path):
    from tabloom import clean, read_csv

    result = clean(read_csv(spark, messy_path), "flag")
    result.table = result.table.cache()
    return result
