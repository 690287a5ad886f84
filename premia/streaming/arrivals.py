"""Arriving files as streams: first-seen rows, checkpointed sinks, work triggered by new batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# whether RocksDB looks every id up once more when it is written, to report how many there are
STATE_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
# a packed row comes back as it was, microseconds and nulls included
_PACKED = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def read_arrivals(spark: SparkSession, path: str, schema: T.StructType, *, max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A folder whose new files are the stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    return reader.load(path)


def with_provenance(stream: DataFrame, *, query: str, area: int) -> DataFrame:
    """Where and when a row arrived; never features."""
    return stream.withColumns({
        "_search_query": F.lit(query), "_area_id": F.lit(area), "_collected_at": F.current_timestamp(),
        "_source_file": F.col("_metadata.file_path"),
    })


def first_seen(stream: DataFrame, id_col: str, time_col: str, within: str) -> DataFrame:
    """First arrival of each id; ids are remembered for ``within`` event time, so the state stays bounded."""
    return stream.withWatermark(time_col, within).dropDuplicatesWithinWatermark([id_col])


def start_sink(
    stream: DataFrame, path: str, checkpoint: str, *, interval: str | None = None, partition_by: str | None = None
) -> StreamingQuery:
    """Append to a parquet table, exactly once per checkpoint. Without an interval: take what is there, then stop."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def first_of_each(stream: DataFrame, id_col: str, order: str) -> DataFrame:
    """The first row of every id that ever arrives, by keyed state without a time limit.

    The state is one aggregate per id, kept by the state store beside the task that meets the id: a batch reads its own rows and
    the state of its own ids, however many ids were seen before. Within a batch the row of the smallest ``order`` wins
    (null first, ties by the whole row). Rows without id count as one id. To be written in update mode: an id that was met
    in any batch of another time is left out, also if the clock was set back in between.
    """
    now = F.current_timestamp()  # one time per batch, the same when it is replayed
    # Rows that tie have one id and one order, so these need not be packed to break ties, nor parsed: the state has them already.
    held = {c: at for c, at in ((id_col, F.col("id")), (order, F.col("first.order"))) if _equal_is_same(stream.schema, c)}
    rest = T.StructType([f for f in stream.schema.fields if f.name not in held])
    row = F.to_json(F.struct(*rest.names), _PACKED) if rest.names else F.lit("{}")
    packed = stream.select(now.alias("at"), F.col(id_col).alias("id"), F.col(order).alias("order"), row.alias("row"))
    seen = packed.groupBy("id").agg(F.min(F.struct("at", "order", "row")).alias("first"), F.max("at").alias("last"))
    kept = seen.where((F.col("first.at") == now) & (F.col("last") == now))
    if rest.names:
        kept = kept.withColumn("r", F.from_json("first.row", rest, _PACKED))
    return kept.select(*[(held[c] if c in held else F.col("r")[c]).alias(c) for c in stream.columns])


def _equal_is_same(schema: T.StructType, name: str) -> bool:
    """Whether equal values of a column are the same value: not so for floating zeros and collated texts."""
    types = [f.dataType for f in schema.fields if f.name == name]
    return any(isinstance(t, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)) or t == T.StringType() for t in types)


def start_exact_first_seen(
    stream: DataFrame, path: str, checkpoint: str, id_col: str, order: str, *, interval: str | None = None,
    on_batch: Callable[[DataFrame, DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Exact first-seen store without a time limit (`first_of_each`, its state in RocksDB under ``checkpoint``).

    A replayed batch starts from the state of the batch before and overwrites its own partition, so a lost driver or
    executor leaves no copies and no gaps. The number of ids in the state is not counted unless `STATE_ROWS` is set: that takes
    a look-up for each write. ``on_batch(new, stored_before, batch_id)`` is called for every stored batch, again
    when it is replayed: work that must not be repeated goes through `versions.once`. ``stored_before`` is read only if used.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        if on_batch:
            schema = T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())])
            stored = spark.read.schema(schema).parquet(path).where(F.col("batch") < batch_id)
            on_batch(spark.read.schema(batch.schema).parquet(target), stored.drop("batch"), batch_id)

    conf = stream.sparkSession.conf
    before = {name: conf.get(name, None) for name in (STATE_STORE, STATE_ROWS)}
    conf.set(STATE_STORE, ROCKSDB)  # read when the query starts
    conf.set(STATE_ROWS, before[STATE_ROWS] or "false")
    try:
        writer = first_of_each(stream, id_col, order).writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def progress(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch id, rows read) of the recent batches."""
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress]
