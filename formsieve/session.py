"""Session settings the operators rely on, and the one place that cuts lineage."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE picks broadcast sides from measured sizes (no operator forces one) and splits skewed join partitions, also where
# an aggregation on the same key follows.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Java's own case mapping: about ten times the speed of ICU's on page text.
    "spark.sql.icu.caseMappings.enabled": "false",
    # The JVM never compiles a method above 8,000 bytes of code; a projection that would become one is generated in pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("formsieve")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir, or the one its driver has set with setCheckpointDir."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def run_folder(spark: SparkSession) -> str:
    """Folder of everything this application writes on the way; it goes when the application ends, or with `release`."""
    folder = f"{scratch_folder(spark)}/formsieve-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables written so far, once the results that read them are out."""
    discard(spark, run_folder(spark))


def discard(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` as a table into the run's folder and read it back: several branches use it, none recomputes it, and a
    lost executor does not reach behind it. Readers prune its columns and know its size."""
    path = f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
