"""Streams give the same tables whether events come as one file or as shuffled part files in a folder."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

NAMES = sorted(n for n in E.queries() if n.startswith("stream_"))


@pytest.fixture(scope="module")
def shuffled(spark, sf, tmp_path_factory):
    """The smoke directory with events as 4 files, each with rows of all times."""
    out = tmp_path_factory.mktemp("parts")
    rows = spark.read.parquet(f"{sf}/events.parquet")
    rows.repartition(4, F.xxhash64("event_id")).write.parquet(str(out / "events.parquet"))
    assert len(list((out / "events.parquet").glob("part-*.parquet"))) == 4
    return str(out)


@pytest.mark.parametrize("name", NAMES)
def test_many_files_in_any_order(spark, sf, shuffled, name):
    rows = [sorted(map(repr, E.queries()[name](spark, d).collect())) for d in (sf, shuffled)]
    assert rows[0] and rows[0] == rows[1]


@pytest.fixture(scope="module")
def feed(spark, sf, tmp_path_factory):
    """The events in time order as 5 files, an hour's rows of the first file once more at the end: those come late."""
    from pyspark.sql import Window
    out = tmp_path_factory.mktemp("feed") / "events.parquet"
    rows = spark.read.parquet(f"{sf}/events.parquet").withColumn("slice", F.ntile(5).over(Window.orderBy("ts"))).cache()
    late = rows.where("slice = 1 and event_id % 7 = 0").withColumn("event_id", F.col("event_id") + 1_000_000)
    for i in range(1, 6):
        rows.where(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(str(out))
        time.sleep(1.1)  # files are taken in order of their time
    late.drop("slice").coalesce(1).write.mode("append").parquet(str(out))
    return str(out.parent), late.count()


def test_windows_close_and_late_rows_are_kept(spark, feed):
    from halyard.sources import fixtures as X
    from halyard.streaming import runner as SR
    path, n_late = feed
    rows = SR.with_event_time(X.health_checks(spark, "", src=SR.stream_table(spark, path, "events")))
    aggs = {"n": ("sum", F.lit(1).cast("bigint")), "worst": ("max", F.col("latency_ms")), "best": ("min", F.col("latency_ms"))}
    got = SR.windowed(rows, "1 minute", ["service"], aggs, "test", "3 hours")
    read, late, open_after, closed = zip(*[b[1:] for b in got.batches])
    assert sum(read) == 1000 + n_late and sum(late) == n_late
    assert got.late.agg(F.sum("_rows")).first()[0] == n_late
    assert max(open_after) < 200 and sum(closed) > 700          # only the delay's windows are carried
    assert open_after[-1] <= open_after[0] or open_after[-1] < 50
    h = X.health_checks(spark, path)
    want = h.groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("window_start"), "service").agg(
        F.count(F.lit(1)).alias("n"), F.max("latency_ms").alias("worst"), F.min("latency_ms").alias("best"))
    assert sorted(map(tuple, got.result().select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_restarted_stream_goes_on(spark, sf, tmp_path):
    """Files that come after a stop are added to the windows that were open; the last batch may be repeated."""
    from halyard.streaming import runner as SR
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts").orderBy("ts").collect()
    schema, folder, base = "event_id long, ts timestamp_ntz", str(tmp_path / "in"), str(tmp_path / "state")
    got, counts = None, []
    for part in (rows[:400], rows[400:700], rows[350:360] + rows[700:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = SR.with_event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder))
        got = SR.windowed(stream, "1 hour", [], {"n": ("sum", F.lit(1).cast("bigint"))}, delay="2 hours", base=base)
        counts.append(sum(b[1] for b in got.batches))
        time.sleep(1.1)
    assert counts == [400, 300, 310] and got.late.agg(F.sum("_rows")).first()[0] == 10
    want = {}
    for r in rows + rows[350:360]:
        hour = r["ts"].replace(minute=0, second=0, microsecond=0)
        want[hour] = want.get(hour, 0) + 1
    assert {r["window_start"]: r["n"] for r in got.result().collect()} == want


def test_requests_are_decided_while_the_stream_runs(spark, feed):
    from halyard.sources import fixtures as X
    from halyard.streaming import runner as SR
    from halyard.streaming.stateful import DECIDED, RateLimiter
    path, n_late = feed
    limit, window = 2, 10 * 86_400_000_000
    out, running = SR.run_processor(SR.stream_table(spark, path, "events"),
                                     lambda e: X.gateway_requests(spark, "", src=e).select("request_id", "client_id", "ts"),
                                     "client_id", RateLimiter(limit, window), DECIDED, "1 day", name="test")
    assert running.count() > 700                                 # most are decided before the input ends
    got = {r["request_id"]: r["rejected"] for r in out.collect()}
    assert len(got) == 1000                                      # rows later than the delay are not decided
    accepted, want = {}, {}
    for r in X.gateway_requests(spark, path).where("request_id < 1000000").orderBy("ts", "request_id").collect():
        t = int(r["ts"].timestamp() * 1_000_000)
        kept = [a for a in accepted.get(r["client_id"], []) if t - a < window]
        want[r["request_id"]] = len(kept) >= limit
        accepted[r["client_id"]] = kept if want[r["request_id"]] else [*kept, t]
    assert got == want and any(want.values())


def test_silence_is_reported_during_the_outage(spark, tmp_path):
    import datetime as dt
    from halyard.streaming import runner as SR
    from halyard.streaming.stateful import SILENT, SilenceWatch
    t0, schema = dt.datetime(2024, 1, 1), "service string, status string, ts timestamp_ntz"
    files = [[("a", 0), ("a", 30), ("b", 10), ("b", 50)], [("b", 100), ("b", 150)], [("b", 200), ("b", 250)], [("a", 300), ("b", 300)]]
    for rows in files:  # a is silent from 30 to 300, and at the end c, which only failed
        spark.createDataFrame([(s, "healthy", t0 + dt.timedelta(seconds=x)) for s, x in rows] + [("c", "unhealthy", t0 + dt.timedelta(seconds=rows[0][1]))], schema) \
            .coalesce(1).write.mode("append").parquet(str(tmp_path / "h"))
        time.sleep(1.1)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "h"))
    out, running = SR.run_processor(events, lambda e: e.select("service", "status", "ts"), "service", SilenceWatch(60_000_000), SILENT, "5 seconds", name="test")
    assert [(r["service"], r["until_us"]) for r in running.collect()] == [("a", None)]
    at = int(t0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = sorted(((r["service"], r["from_us"] // 1_000_000 - at, r["until_us"] and r["until_us"] // 1_000_000 - at) for r in out.collect()), key=str)
    assert got == [("a", 90, 300), ("a", 90, None)]
