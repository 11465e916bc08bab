"""Incremental ingest of chunk files and throughput of arriving work."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogproof import schemas
from catalogproof.operators import dedupe, scaling
from catalogproof.sources.chunks import CHUNK_ORDER, chunk_frame, read_objects
from catalogproof.sources.tables import holds_table


#: folders over which ids are dealt, so that a batch looks for its own in few of them
BUCKETS = 64
#: unreadable files that are tried again at a time
RETRIED = 1000


def _flag_path(table: str) -> str:
    return f"{table.rstrip('/')}_flags"


def chunk_flags(spark: SparkSession, table: str) -> DataFrame:
    """The latest flags of every chunk object that was taken in, with its category and place."""
    stored = spark.read.parquet(_flag_path(table))
    newest = F.max_by(F.struct(*[c for c in stored.columns if c != "taken"]), "taken").alias("f")
    return stored.groupBy("chunk_file", "chunk_start", "part").agg(newest).select("f.*")


def _pending_path(table: str) -> str:
    return f"{table.rstrip('/')}_pending"


def unreadable_files(spark: SparkSession, table: str) -> DataFrame:
    """(chunk_file, tried): files none of whose objects could be read when they were taken in last.

    Only files that were unreadable once are looked at, whatever was taken in besides.
    """
    if not holds_table(spark, _pending_path(table)):
        return spark.createDataFrame([], "chunk_file string, tried timestamp")
    marks = spark.read.parquet(_pending_path(table))
    last = marks.groupBy("chunk_file").agg(F.max("tried").alias("tried"), F.max_by("unreadable", "tried").alias("unreadable"))
    return last.filter("unreadable").select("chunk_file", "tried")


def _pending(spark: SparkSession, table: str) -> Iterator[list[str]]:
    """All unreadable files as they are now, those tried longest ago first, ``RETRIED`` at a time."""
    # written, because a retry adds marks
    files = scaling.materialize(unreadable_files(spark, table), "pending")
    if files.isEmpty():
        return
    numbered = scaling.materialize(scaling.global_rank(files, ["tried", "chunk_file"], "number"), "numbered")
    for start in range(0, numbered.count(), RETRIED):
        part = numbered.filter(F.col("number").between(start + 1, start + RETRIED))
        yield [r["chunk_file"] for r in part.orderBy("number").collect()]


def ingest_chunks(
    spark: SparkSession, source: str, table: str, checkpoint: str, max_files: int | None = None, buckets: int = BUCKETS
) -> int:
    """Append the records of chunk files not processed before; returns the batches run.

    Each id enters the table once, whichever file or source it comes in; a null id or category is
    one like any other.  The known ids are the table itself, dealt over ``buckets`` folders by hash; a batch
    reads only the folders of its own ids, and while its ids are few enough to broadcast (`scaling.counted_few`), the known ones
    pass by where they are read and are not shuffled.  A batch writes its own folder, named by the stream as well, so a
    batch that is run again replaces itself and a new checkpoint replaces nothing.  Flags are kept beside
    the rows; files that could not be read stay pending and are all tried again by every run, ``RETRIED`` at a time.
    """
    reader = (
        spark.readStream.schema(schemas.CHUNK_FILE)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    objects = reader.json(source).withColumn("_file", F.col("_metadata.file_path"))
    ran = []

    def store(batch: DataFrame, run: str, batch_id: int, again: bool = False) -> None:
        session = batch.sparkSession
        held = scaling.materialize(batch, "arrived")
        rows, flags = chunk_frame(held, F.col("_file"))
        flags = flags.withColumn("taken", F.current_timestamp())
        flags.write.mode("overwrite").parquet(f"{_flag_path(table)}/run={run}/batch={batch_id}")
        # a file is marked when it cannot be read, and again when it is tried once more
        files = flags.groupBy("chunk_file").agg(F.bool_and("unreadable").alias("unreadable"), F.max("taken").alias("tried"))
        files.filter(F.col("unreadable") | F.lit(again)).write.mode("overwrite").parquet(f"{_pending_path(table)}/run={run}/batch={batch_id}")
        ids = ["category", "record_id"]
        bucket = F.pmod(F.xxhash64(*ids), F.lit(buckets)).cast("int")
        fresh = dedupe.keep_first(rows.drop("_file"), ids, CHUNK_ORDER).withColumn("bucket", bucket)
        fresh = scaling.materialize(fresh, "fresh")
        if holds_table(session, table):
            touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
            known = session.read.option("mergeSchema", False).parquet(table)
            known = known.filter(F.col("bucket").isin(touched) & ~((F.col("run") == run) & (F.col("batch") == batch_id)))
            fresh = scaling.null_safe(fresh, known_of(known.select(*ids), fresh, ids), ids, "left_anti")
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/run={run}/batch={batch_id}")
        ran.append(batch_id)

    def batch_of_stream(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # a stream may end with a batch of no files
            return
        identity = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        store(batch, f"s-{identity}", batch_id)

    if holds_table(spark, _flag_path(table)):
        retry = f"r-{uuid.uuid4().hex}"
        for number, files in enumerate(_pending(spark, table)):
            objects_again = read_objects(spark, files).withColumn("_file", F.col("_metadata.file_path"))
            store(objects_again, retry, number, again=True)
    query = (
        objects.writeStream.foreachBatch(batch_of_stream)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(ran)


def known_of(known: DataFrame, fresh: DataFrame, ids: list[str]) -> DataFrame:
    """The known ids that a batch (written) holds too: looked up in a broadcast of the batch's, if these are few."""
    wanted = fresh.select(*ids)
    return scaling.null_safe(known, F.broadcast(wanted), ids, "left_semi") if scaling.counted_few(wanted) else known


def throughput(
    arrivals: DataFrame, ts: str, seconds: int, late: str | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """Arrivals per interval and per hour; give ``late`` (a watermark) on a stream."""
    timed = arrivals.withWatermark(ts, late) if late else arrivals
    slot = F.window(F.col(ts), f"{seconds} seconds")
    counted = timed.groupBy(slot.alias("_w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.col("_w.start").alias("window_start"),
        *by,
        "n",
        (F.col("n") * 3600 / seconds).alias("per_hour"),
    )


def with_idle(counted: DataFrame, seconds: int) -> DataFrame:
    """The intervals of ``throughput`` (without ``by``) and, with 0, those between them in which nothing arrived."""
    numbered = counted.withColumn("_slot", F.floor(F.unix_timestamp("window_start") / seconds))
    ends = numbered.agg(F.min("_slot").alias("_from"), F.max("_slot").alias("_to"))
    slots = scaling.explode_range(ends, F.col("_from"), F.col("_to"), "_slot", ["_from"]).select("_slot")
    return slots.join(numbered, "_slot", "left").select(
        F.timestamp_seconds(F.col("_slot") * seconds).alias("window_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("per_hour", F.lit(0.0)).alias("per_hour"),
    )


def hours_left(remaining: Column, per_hour: Column) -> Column:
    """Hours to go at a rate; null when nothing arrives, which is a stall and not zero hours."""
    return F.when(per_hour > 0, remaining / per_hour)


def progress_state(remaining: Column, per_hour: Column) -> Column:
    return (
        F.when(remaining <= 0, F.lit("done")).when(per_hour > 0, F.lit("running")).otherwise(F.lit("stalled"))
    )
