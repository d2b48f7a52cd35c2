"""Streams over event files.

Sinks that accumulate write one folder per micro-batch, in overwrite mode, so a batch
that is replayed after a failure replaces itself; readers sum the folders. Nothing
stored is rewritten while the stream runs; ``compact`` folds the folders afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from scholarmart.operators.access import rate_limit, window_counts
from scholarmart.operators.aggregates import daily_counts
from scholarmart.operators.joins import credit_authors
from scholarmart.sources.tables import exists as table_exists_at

BATCH = "batch_id"


def event_stream(spark: SparkSession, path: str, schema: T.StructType, files: str = "*.parquet", per_trigger: int | None = None) -> DataFrame:
    """Files of a folder as a stream; the schema is given."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time with a watermark; a time without zone is read as UTC first."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


METRICS = T.StructType([T.StructField("entradas", T.LongType()), T.StructField("tardias", T.LongType())])


class BatchMetrics(StreamingQueryListener):
    """Rows read and rows dropped as too late of every micro-batch; unlike ``recentProgress``, of all of them.

    Late rows are those that reached a stateful operator behind the watermark: single rows before a de-duplication or a join, groups
    of rows before an aggregation, which Spark combines first. A batch that is run again counts once.
    """

    def __init__(self) -> None:
        self.batches: dict[int, tuple[int, int]] = {}

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        read, dropped = self.batches.get(progress.batchId, (0, 0))  # an idle batch is reported under its number once more
        self.batches[progress.batchId] = (max(read, progress.numInputRows), max(dropped, late))

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    @property
    def late(self) -> int:
        return sum(dropped for _, dropped in self.batches.values())


def run(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", metrics: str | None = None) -> StreamingQuery:
    """Process what is there and stop; results go to a folder, and rows read and late rows of every batch to ``metrics`` if named."""
    spark = stream.sparkSession
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    listener = BatchMetrics()
    if metrics:
        spark.streams.addListener(listener)
    try:
        query = writer.outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
        if metrics:
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        if metrics:
            spark.streams.removeListener(listener)
    for batch_id, counts in sorted(listener.batches.items()):
        put_batch(spark.createDataFrame([counts], METRICS), metrics, batch_id)
    return query


def run_each(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def put_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All folders of a sink, or those of earlier batches."""
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    if not table_exists_at(spark, path):
        return spark.createDataFrame([], whole)
    df = spark.read.schema(whole).parquet(path)
    return df if before is None else df.filter(F.col(BATCH) < before)


# --- daily facts and counters -------------------------------------------------

DAILY = T.StructType(
    [
        T.StructField("fecha", T.DateType()),
        T.StructField("id_documento", T.LongType()),
        T.StructField("id_tipo_interaccion", T.IntegerType()),
        T.StructField("cant_interacciones", T.LongType()),
    ]
)


def daily_rollup(events: DataFrame, interaction: int, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch stores its daily counts per document."""

    def step(batch: DataFrame, batch_id: int) -> None:
        put_batch(daily_counts(batch, interaction).select(*[F.col(f.name).cast(f.dataType) for f in DAILY]), path, batch_id)

    return run_each(events, checkpoint, step)


def daily_fact(spark: SparkSession, path: str) -> DataFrame:
    keys = ["fecha", "id_documento", "id_tipo_interaccion"]
    return read_batches(spark, path, DAILY).groupBy(*keys).agg(F.sum("cant_interacciones").alias("cant_interacciones"))


def daily_author_fact(spark: SparkSession, path: str, bridge: DataFrame) -> DataFrame:
    return credit_authors(daily_fact(spark, path), bridge)


def popularity_counter(queries: DataFrame, path: str, checkpoint: str, text: str = "query_texto") -> StreamingQuery:
    """Each micro-batch stores how often every query was asked."""

    def step(batch: DataFrame, batch_id: int) -> None:
        put_batch(batch.groupBy(F.col(text).alias("query_texto")).agg(F.count("*").alias("score")), path, batch_id)

    return run_each(queries, checkpoint, step)


SCORES = T.StructType([T.StructField("query_texto", T.StringType()), T.StructField("score", T.LongType())])


def running_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, SCORES).groupBy("query_texto").agg(F.sum("score").alias("score"))


def compact(df: DataFrame, path: str) -> None:
    """Write the folded content of a sink to another folder."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


# --- limits, sessions, revocation ---------------------------------------------


def limit_verdicts(
    requests: DataFrame, path: str, checkpoint: str, limit: int, seconds: int = 60, user: str = "user_id", ts: str = "ts", key: str = "event_id"
) -> StreamingQuery:
    """Verdict per request, on top of what earlier batches counted in the same window."""
    spark = requests.sparkSession
    counted = T.StructType([requests.schema[user], T.StructField("ventana", T.LongType()), T.StructField("n", T.LongType())])

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        now = window_counts(batch, seconds, user, ts)
        oldest = now.agg(F.min("ventana")).first()[0]
        if oldest is not None:
            earlier = read_batches(spark, f"{path}/counts", counted, batch_id).filter(F.col("ventana") >= oldest)
            used = earlier.groupBy(user, "ventana").agg(F.sum("n").alias("n"))
            put_batch(rate_limit(batch, limit, seconds, user, ts, key, used), f"{path}/verdicts", batch_id)
            put_batch(now, f"{path}/counts", batch_id)
        batch.unpersist()

    return run_each(requests, checkpoint, step)


def windowed_counts(requests: DataFrame, delay: str, window: str, slide: str | None = None, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Requests per user and fixed or sliding window, given out once the watermark has passed."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    counts = timed(requests, ts, delay).groupBy(user, span.alias("w")).agg(F.count("*").alias("n"))
    return counts.select(user, F.col("w.start").alias("inicio"), "n")


def stream_sessions(events: DataFrame, delay: str, gap: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    sessions = timed(events, ts, delay).groupBy(user, F.session_window(ts, gap).alias("s")).agg(F.count("*").alias("eventos"))
    return sessions.select(user, F.col("s.start").alias("inicio"), F.col("s.end").alias("fin"), "eventos")


def stream_deduplicated(events: DataFrame, delay: str, keys: Sequence[str] = ("event_id",), ts: str = "ts") -> DataFrame:
    """Replayed events count once within the delay."""
    return timed(events, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_revoked(requests: DataFrame, revocations: DataFrame, delay: str, ttl_seconds: int, token: str, key: str = "event_id", ts: str = "ts") -> DataFrame:
    """Requests with the revocation that hit them, or null; both sides bounded by the time a revocation lives.

    A request without one is given out once the watermark has passed it. Overlapping revocations of one token give one row each.
    """
    asked = timed(requests, ts, delay)
    marks = timed(revocations.select(F.col(token).alias("_token"), F.col(ts).alias("set_at")), "set_at", delay)
    ends = F.col("set_at") + F.expr(f"interval {int(ttl_seconds)} seconds")
    hit: Column = (F.col(token) == F.col("_token")) & (F.col(ts) >= F.col("set_at")) & (F.col(ts) < ends)
    return asked.join(marks, hit, "left_outer").select(key, token, ts, "set_at")


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``entradas, tardias, batch_id`` of every batch that ``run`` has stored."""
    return spark.read.schema(T.StructType([*METRICS.fields, T.StructField(BATCH, T.LongType())])).parquet(path)


def dropped_late(spark: SparkSession, path: str) -> int:
    """Rows dropped as too late in all runs that stored their metrics there."""
    return batch_metrics(spark, path).agg(F.coalesce(F.sum("tardias"), F.lit(0))).first()[0]
