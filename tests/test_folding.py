import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.operators import sketches
from scholarmart.sources import versions
from scholarmart.streaming import folding
from tests.conftest import utc

KEYS = T.StructType([T.StructField("k", T.StringType())])
ROWS = "ts timestamp, k string"


def data_files(root):
    return sum(f.endswith(".parquet") for _, _, files in os.walk(f"{root}/_data") for f in files)


def batch(spark, rows):
    return spark.createDataFrame(rows, ROWS).coalesce(1)


def counts(rows):
    out = {}
    for ts, k in rows:
        key = (ts.date() if ts else None, k)
        out[key] = out.get(key, 0) + 1
    return out


def stored(spark, root, since=None):
    return {(r["dia"], r["k"]): r["n"] for r in folding.folded(spark, root, KEYS, since).collect()}


@pytest.fixture
def one_task(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_months_of_days(spark, tmp_path):
    root = str(tmp_path / "sink")
    rows = [[(utc(2026, m, d), "a") for m in (1, 2) for d in (1, 9, 9 + i)] + [(None, "b")] for i in range(3)]
    for i, part in enumerate(rows):
        folding.fold_batch(batch(spark, part), i, root, ["k"], F.col("ts"), most=2, grain="month")
    now = versions.manifest(spark, root)
    assert len(now.tables[folding.TABLE]) == 3 and stored(spark, root) == counts(sum(rows, []))
    late = folding.folded(spark, root, KEYS, dt.date(2026, 1, 11), "month")
    assert {r["dia"] for r in late.collect()} == {dt.date(2026, 1, 11)} | {dt.date(2026, 2, d) for d in (1, 9, 10, 11)}
    with pytest.raises(ValueError):
        folding.fold_batch(batch(spark, []), 9, root, ["k"], F.col("ts"), keep_days=1, grain="month")


def test_files_stay_bounded_over_200_batches(spark, tmp_path, one_task):
    root, rng, seen, most_files = str(tmp_path / "sink"), random.Random(3), [], 0
    for i in range(200):
        rows = [(utc(2026, 1, 1 + i // 100, rng.randrange(24)), rng.choice(["a", "a", "b", None])) for _ in range(3)]
        folding.fold_batch(batch(spark, rows), i, root, ["k"], F.col("ts"), most=8, spare_seconds=0)
        seen += rows
        most_files = max(most_files, data_files(root))
    now = versions.manifest(spark, root)
    assert max(len(f) for f in now.tables[folding.TABLE].values()) < 8 and now.version == 200 and len(now.runs) == 1
    assert most_files <= 40 and len(os.listdir(f"{root}/_versions")) <= 40  # two days, their folds, and what one vacuum leaves to the next
    assert stored(spark, root) == counts(seen)


def test_a_replayed_batch_counts_once_and_days_expire(spark, tmp_path):
    root = str(tmp_path / "sink")
    rows = [[(utc(2026, 1, d), "a"), (utc(2026, 1, d), None), (None, "a")] for d in (1, 2, 5, 6)] + [[(utc(2026, 1, 1), "late")]]
    for i, part in enumerate(rows):
        for _ in range(2):
            folding.fold_batch(batch(spark, part), i, root, ["k"], F.col("ts"), most=3, keep_days=2)
    days = (dt.date(2026, 1, 5), dt.date(2026, 1, 6))
    assert stored(spark, root) == {(d, k): 1 for d in days for k in ("a", None)} | {(None, "a"): 4}
    assert set(stored(spark, root, days[1])) == {(days[1], "a"), (days[1], None)}


def test_fold_as_a_stream_over_a_restart(spark, tmp_path):
    src, root, checkpoint = (str(tmp_path / x) for x in ("in", "sink", "cp"))
    rows = [(utc(2026, 1, 1 + i % 2), "a" if i % 3 else "b") for i in range(30)]
    for i in range(6):
        batch(spark, rows[5 * i : 5 * i + 5]).write.parquet(f"{src}/f{i}")
        if i in (2, 5):
            stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
            folding.fold_counts(stream, root, checkpoint, ["k"], F.col("ts"), most=2)
    assert stored(spark, root) == counts(rows) and versions.manifest(spark, root).runs == ("5",)


def test_an_empty_batch_and_an_empty_sink(spark, tmp_path):
    root = str(tmp_path / "sink")
    assert stored(spark, root) == {}
    folding.fold_batch(batch(spark, []), 0, root, ["k"], F.col("ts"))
    assert stored(spark, root) == {} and versions.manifest(spark, root).runs == ("0",)


def test_daily_sketches_merge(spark):
    df = spark.range(60000).select((F.col("id") % 20000).alias("user"), (F.col("id") % 7).cast("int").alias("d"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("k"))
    day = F.date_add(F.lit(dt.date(2026, 1, 1)), F.col("d"))
    daily = sketches.daily_sketches(df, ["k"], day, "user")
    assert daily.count() == 14
    got = {r["k"]: r["n"] for r in sketches.merged_distinct(daily, ["k"], "n").collect()}
    want = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.countDistinct("user").alias("n")).collect()}
    assert all(abs(got[k] - n) <= 5 * sketches.relative_error() * n for k, n in want.items()) and set(got) == set(want)
    few = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1)], "user int, k int")
    assert sketches.merged_distinct(sketches.daily_sketches(few, ["k"], F.lit(dt.date(2026, 1, 1)), "user"), ["k"], "n").first()["n"] == 2
