"""Session settings and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: str | None = None

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # merge sessions before the shuffle, so a busy user travels as sessions, not as events
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # a dynamic overwrite replaces only the partitions that are written
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every operator relies on."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "scholarmart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by all executors, as named in ``spark.checkpoint.dir``.

    A folder of our own, one for the process, is only made where the setting is absent and
    the session has no executors of their own; a cluster without the setting is an error.
    """
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    _own = _own or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="scholarmart-")
    return _own


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; survives the loss of executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_dir(spark)}/scholarmart/{name}-{uuid.uuid4().hex}"


#: whether the shuffle files of a query go when it ends
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go as each ends; else they lie on disk until the driver happens to collect its garbage.

    A frame that is run twice inside is shuffled twice. Scopes may be nested.
    """
    was = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, was)


def pieces(key: str, *sources: DataFrame, each: int = 16 << 20, most: int = 8) -> list[Callable[[DataFrame], DataFrame]]:
    """What cuts frames into up to ``most`` pieces by a key that joins and groups have, to be written one after the other.

    A piece goes down to the scans, so the shuffles that lie on disk together are those of one piece. Small ``sources`` make one piece.
    """
    n = min(most, tasks_for(*sources, each=each, least=1))
    whole = F.xxhash64(F.col(key).cast("string"))  # frames may have the key in other types
    return [lambda df, k=k: df.filter(F.pmod(whole, F.lit(n)) == k) if n > 1 else df for k in range(n)]


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(*frames: DataFrame, each: int = 4 << 20, least: int | None = None) -> int:
    """How many tasks the files that some frames are read from are worth, so that what one task holds does not grow with the input."""
    sc = frames[0].sparkSession.sparkContext
    bytes_read = 0
    for file in {f for df in frames for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(file)
        bytes_read += path.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return max(sc.defaultParallelism if least is None else least, -(-bytes_read // each))
