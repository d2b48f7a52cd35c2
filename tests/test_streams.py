import datetime as dt
import random

from pyspark.sql import functions as F

from scholarmart.operators.access import rate_limit
from scholarmart.streaming import jobs, state
from tests.conftest import utc

SCHEMA = "event_id long, user_id long, ts timestamp"


def write_files(spark, path, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/f{i}")


def test_verdicts_over_several_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(i, 7 if i % 3 else 8, utc(2026, 1, 1) + dt.timedelta(seconds=i)) for i in range(90)]
    write_files(spark, src, [rows[:30], rows[30:60], rows[60:]])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
    out = str(tmp_path / "out")
    jobs.limit_verdicts(stream, out, str(tmp_path / "cp"), 10, 60)
    got = spark.read.parquet(f"{out}/verdicts")
    assert got.select("batch_id").distinct().count() == 3
    # arrival order of the files is their time order, so the verdicts are those of one batch
    batch = rate_limit(spark.createDataFrame(rows, SCHEMA), 10, 60).filter("aceptado").groupBy("user_id", "ventana").count()
    accepted = got.filter("aceptado").groupBy("user_id", "ventana").count()
    assert {tuple(r) for r in accepted.collect()} == {tuple(r) for r in batch.collect()}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "sink")
    delta = spark.createDataFrame([("a", 2)], jobs.SCORES)
    for _ in range(3):
        jobs.put_batch(delta, path, 0)
    jobs.put_batch(delta, path, 1)
    assert [tuple(r) for r in jobs.running_scores(spark, path).collect()] == [("a", 4)]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    src = str(tmp_path / "in")
    new = [(1, 7, utc(2026, 1, 2)), (2, 7, utc(2026, 1, 3))]
    late = [(3, 7, utc(2026, 1, 1)), (4, 7, utc(2026, 1, 3, 0, 0, 30))]
    spark.createDataFrame(new, SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src)
    counts = jobs.windowed_counts(stream, "1 minute", "1 minute")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    jobs.run(counts, out, cp)
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.parquet(f"{src}/b")
    jobs.run(counts, out, cp, metrics=f"{out}-metrics")
    assert jobs.dropped_late(spark, f"{out}-metrics") == 1
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] >= 1


def test_late_rows_of_more_batches_than_spark_remembers(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    write_files(spark, src, [[(0, 7, utc(2026, 1, 9))]] + [[(2 * i, 7, utc(2026, 1, 1)), (2 * i + 1, 7, utc(2026, 1, 9, 0, 0, i))] for i in range(1, 9)])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = jobs.run(jobs.stream_deduplicated(stream, "1 minute"), out, cp, metrics=f"{out}-metrics")
        assert len(query.recentProgress) <= 2
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert jobs.dropped_late(spark, f"{out}-metrics") == 7 and spark.read.parquet(out).count() == 10  # the first batch sets the mark of the third
    assert jobs.batch_metrics(spark, f"{out}-metrics").agg(F.sum("entradas")).first()[0] == 17


def test_reading_a_sink_does_not_write(spark, tmp_path):
    path = str(tmp_path / "sink")
    assert jobs.running_scores(spark, path).count() == 0
    assert not (tmp_path / "sink").exists()


def test_verdicts_by_keyed_state_over_a_restart(spark, tmp_path):
    rng, start = random.Random(5), utc(2026, 1, 1)
    when = lambda s: start + dt.timedelta(seconds=s)
    # half of all requests belong to one key
    requests = [(i, 7 if rng.random() < 0.5 else rng.randrange(4), 60 * i + rng.randrange(600)) for i in range(300)]
    marks = [(1000 + i, rng.choice([7, 7, 1, 2]), 900 * i) for i in range(20)]
    schema = "event_id long, user_id long, ts timestamp, mark boolean"
    rows = [(i, u, when(t), False) for i, u, t in requests] + [(i, u, when(t), True) for i, u, t in marks]
    rows.sort(key=lambda r: r[2])
    src = str(tmp_path / "in")
    for mass in (False, True):
        out, cp = str(tmp_path / f"out{mass}"), str(tmp_path / f"cp{mass}")
        src = str(tmp_path / f"in{mass}")

        def go():
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
            asked = stream.filter("not mark").withColumn("iat", F.col("ts") - F.expr("interval 20 minutes"))
            set_ = stream.filter("mark").withColumn("expires_at", F.col("ts") + F.expr("interval 30 minutes"))
            both = state.requests_and_marks(asked, set_, "user_id", issued="iat" if mass else None, mark="ts" if mass else None, salts=3)
            state.run_verdicts(both, 600, out, cp)

        for k, part in enumerate((rows[:110], rows[110:220])):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{src}/f{k}")
        go()
        first = spark.read.parquet(out).count()
        spark.createDataFrame(rows[220:] + [(9999, 5, when(10**6), False)], schema).coalesce(1).write.parquet(f"{src}/f2")  # the last one closes all others
        go()
        live = lambda t, m: m <= t < m + 1800 and (not mass or t - 1200 < m)
        wanted = {i: any(u == v and live(t, m) for _, v, m in marks) for i, u, t in requests}
        got = spark.read.parquet(out).collect()
        assert 0 < first < 300 and len(got) == 300 and {r.pedido: r.rechazado for r in got} == wanted and len(set(wanted.values())) == 2


def test_limit_by_keyed_state_over_a_restart(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    rows = [(i, 7 if i % 3 else 8, utc(2026, 1, 1) + dt.timedelta(seconds=i)) for i in range(200)]
    for k, part in enumerate((rows[:70], rows[70:100], rows[100:])):
        spark.createDataFrame(part[::-1], SCHEMA).coalesce(1).write.parquet(f"{src}/f{k}")
        if k:
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
            state.run_limits(stream, out, cp, 10, 60, 60)
    wanted = {r.event_id: r.aceptado for r in rate_limit(spark.createDataFrame(rows, SCHEMA), 10, 60).collect()}
    got = spark.read.parquet(out).collect()
    assert len(got) == 200 and {r.pedido: r.aceptado for r in got} == wanted
