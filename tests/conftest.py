import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from curvelab.session import prepare

    s = (
        SparkSession.builder.master("local[*]")
        .appName("curvelab-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s


@pytest.fixture(scope="session")
def rows(spark):
    from curvelab.plans.fixtures import class_rows

    return class_rows(spark, SF_MID).cache()


@pytest.fixture()
def shared(spark):
    from curvelab.session import shared_path

    return lambda name="t": shared_path(spark, name)
