import tempfile

import pytest
from pyspark.sql import SparkSession

from tidemark.session import prepare


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.ui.retainedExecutions", "20").config("spark.ui.retainedJobs", "50").config("spark.ui.retainedStages", "50").config("spark.ui.retainedTasks", "1000").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-tests-")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()
