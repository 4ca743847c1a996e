"""Run streams over a file source to the end of their input and read what they gave.

``run_windows`` counts event-time windows with a watermark: every micro-batch is aggregated once, what belongs to
windows that are already closed goes to a table of late rows, the rest is added to the open windows, and windows that
the watermark has passed are appended to the result, once.  Only open windows are carried from batch to batch, so an
endless stream holds the windows of its delay and no more; Spark's own watermark would drop the late rows instead.
``run_processor`` drives a stateful processor with event-time timers (append mode, Spark's state store).

A stream restarted on its folder goes on: batches are written under their number, so a repeated one replaces itself, and
the watermark and the open windows are read back from the batch before.  Nothing is collected but a few numbers a batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.utils import AnalysisException

from halyard.session import scratch_path
from halyard.sources.tables import table_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DELAY = "10 minutes"


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1) -> DataFrame:
    """``readStream`` over a supplied table, one file or a folder of part files (schema taken from the files).

    A stream takes a plain path as a folder; as a pattern (its last letter a class) it may be a file as well.
    """
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path[:-1]}[{path[-1]}]")


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as session-zone ``timestamp`` (the parquet column is ``timestamp_ntz``)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def micros(length: str) -> int:
    """Microseconds of "10 minutes", "1 hour", "3 days"."""
    n, unit = length.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.rstrip("s")] * 1_000_000


def _run(writer, ckpt: str):
    q = writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


class Windows:
    """What a windowed stream gave so far; see ``run_windows``.

    ``batches`` has (batch, rows read, rows late, open windows after it, closed in it).
    """

    def __init__(self, spark: SparkSession, base: str, schema, keys: list[str], merges: dict[str, str]):
        self.spark, self.base, self.schema, self.keys, self.merges = spark, base, schema, keys, merges
        self.batches: list[tuple[int, int, int, int, int]] = []

    def _table(self, name: str, batch: int | None = None) -> DataFrame:
        path = f"{self.base}/{name}" + ("" if batch is None else f"/batch={batch}")
        return self.spark.read.schema(self.schema).parquet(path).select(*self.schema.names)

    def merged(self, df: DataFrame) -> DataFrame:
        """Rows of equal window and keys added up."""
        return df.groupBy("_start", "_end", *self.keys).agg(*[getattr(F, how)(c).alias(c) for c, how in self.merges.items()])

    @property
    def late(self) -> DataFrame:
        """What came after its window was closed, with the number of rows (_rows)."""
        return self._table("late")

    @property
    def closed(self) -> DataFrame:
        return self._table("closed")

    def last_batch(self) -> int | None:
        """The last batch whose watermark is written, in this run or an earlier one."""
        if self.batches:
            return self.batches[-1][0]
        try:
            return self.spark.read.parquet(f"{self.base}/mark").agg(F.max("batch")).first()[0]
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def result(self) -> DataFrame:
        """Closed and open windows, late rows added: every row that was read."""
        last = self.last_batch()
        every = self.spark.createDataFrame([], self.schema) if last is None else \
            self.closed.unionByName(self.late).unionByName(self._table("open", last))
        out = self.merged(every)
        return out.select(F.col("_start").cast("timestamp_ntz").alias("window_start"),
                          *[c for c in out.columns if not c.startswith("_")])


def windowed(rows: DataFrame, window: str, keys: list[str], aggs: dict[str, tuple[str, Column]], name: str = "windows",
             delay: str = DELAY, base: str | None = None) -> Windows:
    """Drive ``rows`` (with event time ``ts``) to the end of the input; with the ``base`` folder of an earlier run, on from there.

    ``aggs``: column -> ("sum", "min" or "max", expression).  The watermark is the latest event time of the batches
    before, less ``delay``; a row is late if its window ended at or before it.
    """
    spark = rows.sparkSession
    base, span, w = base or scratch_path(spark, name), micros(delay), F.window("ts", window)
    part = [getattr(F, how)(c).alias(n) for n, (how, c) in aggs.items()]
    part += [F.count(F.lit(1)).alias("_rows"), F.max(F.unix_micros("ts")).alias("_latest")]
    merges = {n: how for n, (how, _) in aggs.items()} | {"_rows": "sum", "_latest": "max"}

    def counted(df: DataFrame) -> DataFrame:
        return df.where(F.col("ts").isNotNull()).groupBy(w.start.alias("_start"), w.end.alias("_end"), *keys).agg(*part)
    out = Windows(spark, base, counted(spark.createDataFrame([], rows.schema)).schema, keys, merges)

    def write(df: DataFrame, table: str, batch: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{base}/{table}/batch={batch}")
        return out._table(table, batch)

    def step(df: DataFrame, batch: int) -> None:
        before = batch and spark.read.parquet(f"{base}/mark/batch={batch - 1}").first()
        mark = before["mark"] if before else None
        new = write(counted(df), "part", batch)
        seen = new.agg(F.max("_latest").alias("latest"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first()
        ended = F.coalesce(F.unix_micros("_end") <= F.lit(mark), F.lit(False))
        late = write(new.where(ended), "late", batch)
        carried = new.where(~ended)
        if batch:
            carried = out.merged(carried.unionByName(out._table("open", batch - 1)))
        after = mark if seen["latest"] is None else max(mark or 0, seen["latest"] - span)
        done = F.coalesce(F.unix_micros("_end") <= F.lit(after), F.lit(False))
        carried = write(carried, "carried", batch)
        shut, kept = write(carried.where(done), "closed", batch), write(carried.where(~done), "open", batch)
        spark.createDataFrame([(after,)], "mark long").coalesce(1).write.mode("overwrite").parquet(f"{base}/mark/batch={batch}")
        out.batches.append((batch, seen["n"], late.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0], kept.count(), shut.count()))
    _run(rows.writeStream.foreachBatch(step), f"{base}/ckpt")
    return out


def run_windows(rows: DataFrame, window: str, keys: list[str], aggs: dict[str, tuple[str, Column]], name: str = "windows",
                delay: str = DELAY) -> DataFrame:
    """``windowed`` to the end of the input: window_start, keys and aggregates of every row, late ones too."""
    return windowed(rows, window, keys, aggs, name, delay).result()


def run_update(agg: DataFrame, keys: list[str], name: str = "stream") -> DataFrame:
    """Drive an update-mode aggregation over unbounded keys of few values; return the last row per key."""
    spark = agg.sparkSession
    log = scratch_path(spark, f"{name}-log")
    logged = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(log)
        logged.append(batch_id)

    q = _run(agg.writeStream.outputMode("update").foreachBatch(sink), scratch_path(spark, f"{name}-ckpt"))
    if not logged:
        read = sum(p["numInputRows"] for p in q.recentProgress)
        if read:
            raise RuntimeError(f"{name}: {read} rows were read but no batch was logged")
        return spark.createDataFrame([], agg.schema)
    values = F.struct(*[c for c in agg.columns if c not in keys])
    last = spark.read.parquet(log).groupBy(*keys).agg(F.max_by(values, "_batch").alias("_v"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_v.{c}").alias(c) for c in agg.columns])


@contextmanager
def state_store(spark: SparkSession, provider: str = ROCKSDB) -> Iterator[None]:
    """The state store for streams started inside: processors need one with column families."""
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, provider)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, old)


def run_processor(events: DataFrame, rows: Callable[[DataFrame], DataFrame], key: str, processor: StatefulProcessor, schema: str,
                  delay: str, name: str = "processor") -> tuple[DataFrame, DataFrame]:
    """Drive ``processor`` over ``rows(events)`` grouped by ``key`` to the end of the input: all its rows, and those that
    it gave before the input ended.

    When the input has ended, one closing event moves the watermark to the millisecond after the latest event time, so that
    every row is decided as if the stream had gone on; the closing event itself stays undecided.
    """
    spark = events.sparkSession
    closing, out, ckpt = (scratch_path(spark, f"{name}-{part}") for part in ("closing", "out", "ckpt"))
    spark.createDataFrame([], events.schema).write.parquet(closing)
    feed = events.unionByName(spark.readStream.schema(events.schema).parquet(closing))
    timed = with_event_time(rows(feed)).withColumn("t_us", F.unix_micros("ts")).withWatermark("ts", delay)
    result = timed.groupBy(key).transformWithStateInPandas(processor, schema, "Append", "EventTime")
    writer = result.writeStream.outputMode("append").format("parquet").option("path", out)
    with state_store(spark):
        progress = _run(writer, ckpt).recentProgress
        running = spark.read.schema(result.schema).parquet(out)  # the files that are there now
        latest = max((_moment(p["eventTime"]["max"]) for p in progress if "max" in p.get("eventTime", {})), default=None)
        passed = max((_moment(p["eventTime"]["watermark"]) for p in progress if "watermark" in p.get("eventTime", {})), default=None)
        if latest is not None:
            end = max(latest, passed + dt.timedelta(microseconds=micros(delay))) + dt.timedelta(microseconds=micros(delay) + 1000)
            ts = F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")
            spark.range(1).select(*[(ts if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema]) \
                .coalesce(1).write.mode("append").parquet(closing)
            _run(writer, ckpt)
    return spark.read.schema(result.schema).parquet(out), running


def _moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text.replace("Z", "")).replace(tzinfo=None)
