"""Incremental batch operators as streams: keys seen once, tumbling weeks, a ledger kept
up to date by micro-batches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presslake.session import cut_lineage, ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """A stream over a folder of Parquet files, or over a single file."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(there).isFile():
        return reader.option("pathGlobFilter", there.getName()).parquet(there.getParent().toString())
    return reader.parquet(path)


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "2 days") -> DataFrame:
    """The first row of each key; keys are remembered until the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def window_counts(stream: DataFrame, time: str, width: str, keys: list[str], delay: str = "2 days", start: str | None = None) -> DataFrame:
    """Rows per tumbling window and keys; late rows count while their window is open."""
    w = F.window(time, width, startTime=start) if start else F.window(time, width)
    counts = stream.withWatermark(time, delay).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")


class UpsertState:
    """The last row of each key, kept up to date batch by batch in a folder of buckets.

    A batch rewrites the buckets that its keys fall into and no other, so its cost does not
    grow with what is stored.  A manifest per batch says which version of each bucket counts;
    it is written last, so that readers see whole batches, and a batch that is repeated starts
    from the state before it and gives the same."""

    def __init__(self, spark: SparkSession, folder: str, key: str, order: str, buckets: int = 64):
        self.spark, self.folder, self.key, self.order, self.buckets = spark, folder.rstrip("/"), key, order, buckets

    def _fs(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, before: int | None = None) -> dict[int, int]:
        """The version of each bucket, as of the last batch, or the last one before a number."""
        path, fs = self._fs()
        names = sorted(n for n in (s.getPath().getName() for s in (fs.listStatus(path) if fs.exists(path) else [])) if n.startswith("manifest-") and (before is None or int(n[9:18]) < before))
        if not names:
            return {}
        return {int(k): v for k, v in json.loads(self.spark.read.text(f"{self.folder}/{names[-1]}", wholetext=True).first()[0]).items()}

    def _read(self, versions: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.folder}/v{v:09d}/bucket={b}" for b, v in sorted(versions.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def rows(self) -> DataFrame | None:
        """All rows as of the last batch; None before the first."""
        return self._read(self.versions())

    def __call__(self, batch: DataFrame, number: int) -> None:
        from presslake.operators.records import keep_last

        state = self.versions(number)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        batch = cut_lineage(batch)
        touched = sorted(r[0] for r in batch.select(bucket).distinct().collect())  # at most one for each bucket
        old = self._read({b: v for b, v in state.items() if b in touched})
        merged = keep_last(batch if old is None else old.unionByName(batch), [self.key], [F.col(self.order)])
        merged.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/v{number:09d}")
        path, fs = self._fs(f"manifest-{number:09d}.json")
        out = fs.create(path, True)
        out.write(json.dumps(state | dict.fromkeys(touched, number)).encode())
        out.close()
        for b, v in self.versions(number - 1).items():  # replaced by the batch before this one: no reader needs it
            if state.get(b, v) != v:
                old_path, fs = self._fs(f"v{v:09d}/bucket={b}")
                fs.delete(old_path, True)


def upsert_batches(spark: SparkSession, folder: str, key: str, order: str, buckets: int = 64) -> UpsertState:
    """A foreachBatch function that keeps the last row of each key in ``folder``."""
    return UpsertState(spark, folder, key, order, buckets)


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there now and gives the rows it wrote.  Output and
    state lie in the shared folder of checkpoints, a new one for each run."""
    import uuid

    spark = stream.sparkSession
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/stream-{name}-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", f"{base}/out").start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{base}/out")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("append").parquet(f"{base}/out")

    writer.foreachBatch(keep).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def last_state(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last update of each key from :func:`run_to_end` in update mode."""
    w = Window.partitionBy(*keys).orderBy(F.col("_batch").desc())
    return updates.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_batch")
