"""The continuous form of skip-if-done: new extraction files flow in, each document is kept once, in its latest version."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


#: Which arrival a row belongs to, as (time, id): the later arrival wins, whatever files and micro-batches its rows come in.
ARRIVAL = "_arrival"
#: Part files of one Spark write share its id; part files without one are the parts of their folder.
PART_OF_WRITE, PART = r"/part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$", r"^(.*)/part-\d+[^/]*$"


def _arrival_of(path: Column) -> Column:
    write, folder = F.regexp_extract(path, PART_OF_WRITE, 1), F.regexp_extract(path, PART, 1)
    return F.when(write != "", write).when(folder != "", folder).otherwise(path)


def document_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1000, fmt: str = "parquet", version: str | None = None) -> DataFrame:
    """New files of a folder; every row carries its arrival in `_arrival`.

    An arrival is what one Spark write left, or all part files of a folder, or any other file by itself, and is as late as
    its files are. With `version`, the values of that column are the arrivals instead, the highest being the latest.
    """
    rows = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    time = F.col("_metadata.file_modification_time") if version is None else F.col(version)
    name = _arrival_of(F.col("_metadata.file_path")) if version is None else F.col(version).cast("string")
    return rows.select("*", F.struct(time.alias("time"), name.alias("id")).alias(ARRIVAL))


def latest_arrival(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each document all rows of its latest arrival. An arrival is as late as the latest of its rows."""
    arrivals = rows.groupBy(*keys, F.col(f"{ARRIVAL}.id").alias("_id")).agg(F.max(f"{ARRIVAL}.time").alias("_time"))
    top = arrivals.groupBy(*keys).agg(F.max_by("_id", F.struct("_time", "_id")).alias("_top"))
    return rows.join(top, keys).where(F.col(f"{ARRIVAL}.id").eqNullSafe(F.col("_top"))).drop("_top")


def first_arrivals(stream: DataFrame, event_time: str, keys: list[str], delay: str = "1 day") -> DataFrame:
    """Each key once within the delay: state is bounded, so a copy that comes later than that counts as new."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def upsert_by_document(stream: DataFrame, target: str, checkpoint: str, bucket_count: int = 64, available_now: bool = True,
                       keys: tuple[str, ...] = ("doc_id",)) -> StreamingQuery:
    """Keep each document of `stream` in its latest version in the table `target`, a log of arrivals.

    Batch n appends its own rows as folder `version=n`, spread over hash buckets, and repeats it unchanged after a failure. It
    reads nothing else: which arrival of a document counts is decided by readers (`read_latest`), so a batch costs what its
    rows cost, however long the log is. An arrival that comes in several batches is whole once the last is in, and what comes
    late of an older one replaces nothing. `compact` folds the log. Rows without an arrival arrive with their batch.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(bucket_count))

    def write(batch: DataFrame, batch_id: int) -> None:
        arrival = F.col(ARRIVAL) if ARRIVAL in batch.columns else F.struct(F.lit(batch_id).cast("long").alias("time"), F.lit(str(batch_id)).alias("id"))
        batch.withColumn(ARRIVAL, arrival).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/version={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _log(spark: SparkSession, target: str) -> tuple[int, list[int], object, object]:
    """The last folded version (-1 if none), the finished versions behind it, and the folder's file system and path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f.getPath() for f in files.listStatus(path)]
    done = {f.getName() for f in folders if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))}
    numbers = lambda kind: sorted(int(n.removeprefix(kind)) for n in done if n.startswith(kind))
    merged = max(numbers("merged="), default=-1)
    return merged, [n for n in numbers("version=") if n > merged], files, path


def _rows(spark: SparkSession, target: str, merged: int, versions: list[int]) -> DataFrame:
    folders = [f"{target}/merged={merged}"] * (merged >= 0) + [f"{target}/version={n}" for n in versions]
    first, *rest = [spark.read.parquet(f) for f in folders]
    for more in rest:
        first = first.unionByName(more)
    return first


def read_latest(spark: SparkSession, target: str, keys: list[str] | None = None) -> DataFrame:
    """The rows of every document's latest arrival. Arrivals meet within their hash bucket."""
    merged, versions, _, _ = _log(spark, target)
    return latest_arrival(_rows(spark, target, merged, versions), ["bucket", *(keys or ["doc_id"])]).drop(ARRIVAL, "bucket")


def compact(spark: SparkSession, target: str, keys: tuple[str, ...] = ("doc_id",)) -> int:
    """Fold the log: the latest arrivals up to the last finished version become one folder, `merged=n`, which readers take
    from then on with the versions behind it; returns n. A running stream goes on meanwhile, and what it still gets of an
    arrival joins the folded rows of it. The folded folders stay for readers that have begun; `forget` removes them."""
    merged, versions, _, _ = _log(spark, target)
    if not versions:
        return merged
    rows = latest_arrival(_rows(spark, target, merged, versions), ["bucket", *keys])
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/merged={versions[-1]}")
    return versions[-1]


def forget(spark: SparkSession, target: str) -> None:
    """Remove the folders that the last `compact` has folded, once nobody reads them any more."""
    merged, _, files, path = _log(spark, target)
    for folder in [f.getPath() for f in files.listStatus(path)]:
        kind, _, number = folder.getName().partition("=")
        if number.isdigit() and (int(number) < merged or kind == "version" and int(number) == merged):
            files.delete(folder, True)
