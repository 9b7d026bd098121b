import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="tagwright-tests-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tagwright-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", f"file://{scratch}")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
