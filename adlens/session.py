"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; cluster jobs bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName("adlens")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a Python-heavy stage at least one task per core.

    A scan of a few small files yields fewer tasks than the cluster has cores. Only
    then are rows moved, round robin; a large table already has enough splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder named by the cluster in spark.checkpoint.dir.

    Only a session whose executors share this machine may go without: it gets a folder of
    its own, removed at exit. On a cluster an unset folder is an error, as every executor
    would write to its own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import atexit
        import shutil
        import tempfile

        local = tempfile.mkdtemp(prefix="adlens-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        path = "file://" + local
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
