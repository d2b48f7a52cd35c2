"""Limits, expiry, sessions and their streaming twins (T)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.contracts import VIEW
from scholarmart.operators import access
from scholarmart.session import scratch_path
from scholarmart.sources.keyvalue import live_at, seconds_left, with_expiry
from scholarmart.streaming import folding, jobs, state
from scholarmart.suite.registry import query
from scholarmart.suite.roles import TABLES

DAY = 86400
NOON = "2024-01-15 12:00:00"
WINDOW = "CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT)"
LIMIT_SQL = f"SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, {WINDOW} ORDER BY ts, event_id) <= 3 AS aceptado FROM events"


def stream(r, name: str):
    return jobs.event_stream(r.spark, r.dir, TABLES[name], f"{name}.parquet")


def places(r, name: str) -> tuple[str, str]:
    base = scratch_path(r.spark, name)
    return f"{base}/out", f"{base}/checkpoint"


def stored(r, path: str, like):
    return r.spark.read.schema(like.schema).parquet(path)


@query("t_1", LIMIT_SQL)
def t_1(r):
    return access.rate_limit(r.table("events"), 3, DAY).select("event_id", "user_id", "aceptado")


@query("t_1_counts", f"SELECT user_id, {WINDOW} AS ventana, count(*) AS n FROM events GROUP BY ALL")
def t_1_counts(r):
    return access.window_counts(r.table("events"), DAY)


@query("t_1_stream", LIMIT_SQL)
def t_1_stream(r):
    out, checkpoint = places(r, "limit")
    jobs.limit_verdicts(stream(r, "events"), out, checkpoint, 3, DAY)
    return r.spark.read.parquet(f"{out}/verdicts").select("event_id", "user_id", "aceptado")


@query("t_1_state", LIMIT_SQL)
def t_1_state(r):
    """The limit as keyed state: a number for every user and window."""
    out, checkpoint = places(r, "limit-state")
    state.run_limits(stream(r, "events"), out, checkpoint, 3, DAY)
    found = r.spark.read.schema("clave long, pedido long, aceptado boolean").parquet(out)
    return found.select(F.col("pedido").alias("event_id"), F.col("clave").alias("user_id"), "aceptado")


@query(
    "t_2",
    """SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 21599 PRECEDING AND CURRENT ROW) AS n FROM events""",
)
def t_2(r):
    return access.sliding_counts(r.table("events"), 21600).select("event_id", "user_id", "n")


@query(
    "t_2_stream",
    """SELECT user_id, strftime(make_timestamp(b * 10800 * 1000000), '%Y-%m-%d %H:%M:%S') AS inicio, count(*) AS n FROM
       (SELECT user_id, unnest([CAST(floor(epoch(ts) / 10800) AS BIGINT), CAST(floor(epoch(ts) / 10800) AS BIGINT) - 1]) AS b FROM events) GROUP BY ALL""",
)
def t_2_stream(r):
    # the windows are emitted as they change, so that the last ones are there without waiting for a later event
    out, checkpoint = places(r, "sliding")
    counts = jobs.windowed_counts(stream(r, "events"), "1 hour", "6 hours", "3 hours")
    query_ = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query_.foreachBatch(lambda df, batch_id: jobs.put_batch(df, out, batch_id)).start().awaitTermination()
    latest = r.spark.read.parquet(out).groupBy("user_id", "inicio").agg(F.max_by("n", "batch_id").alias("n"))
    return latest.select("user_id", F.date_format("inicio", "yyyy-MM-dd HH:mm:ss").alias("inicio"), "n")


REVOKED_SQL = """SELECT event_id, user_id, EXISTS (SELECT 1 FROM events v WHERE v.event_type = 'error' AND v.user_id = e.user_id
    AND v.ts <= e.ts AND e.ts < v.ts + INTERVAL 1 HOUR) AS rechazado FROM events e WHERE event_type <> 'error'"""


def revocations(r):
    errors = r.table("events").filter("event_type = 'error'")
    return with_expiry(errors, "ts", 3600).select("user_id", "set_at", "expires_at")


@query("t_3", REVOKED_SQL)
def t_3(r):
    requests = r.table("events").filter("event_type <> 'error'")
    return access.revoked(requests, revocations(r), "user_id").select("event_id", "user_id", "rechazado")


@query("t_3_stream", f"SELECT event_id, rechazado FROM ({REVOKED_SQL}) JOIN events USING (event_id) WHERE ts <= (SELECT min(t) - INTERVAL 2 HOUR FROM (SELECT max(ts) AS t FROM events GROUP BY event_type = 'error'))")
def t_3_stream(r):
    """Every request that the watermark has closed, with its flag; later ones wait for the stream to go on."""
    out, checkpoint = places(r, "revoked")
    requests = stream(r, "events").filter("event_type <> 'error'")
    marks = stream(r, "events").filter("event_type = 'error'").select("user_id", "ts")
    flagged = jobs.stream_revoked(requests, marks, "2 hours", 3600, "user_id")
    jobs.run(flagged, out, checkpoint)
    ends = r.table("events").groupBy(F.col("event_type") == "error").agg(F.max("ts").alias("t"))  # the slower of both streams
    closed = ends.agg((F.min("t") - F.expr("interval 2 hours")).alias("t")).scalar()
    hits = stored(r, out, flagged).filter(F.col("ts") <= closed)
    return hits.groupBy("event_id").agg(F.max(F.col("set_at").isNotNull()).alias("rechazado"))


CLOSED = "epoch_ms(ts) < (SELECT max(epoch_ms(ts)) - 7200000 FROM events)"


def verdicts(r, name: str, hours: int, mass: bool):
    """All events as one stream of requests and marks, through keyed state."""
    out, checkpoint = places(r, name)
    events = stream(r, "events")
    requests = events.filter("event_type <> 'error'").withColumn("iat", F.col("ts") - F.expr("interval 6 hours"))
    marks = events.filter("event_type = 'error'").withColumn("expires_at", F.col("ts") + F.expr(f"interval {hours} hours"))
    rows = state.requests_and_marks(requests, marks, "user_id", issued="iat" if mass else None, mark="ts" if mass else None, salts=2)
    state.run_verdicts(rows, 7200, out, checkpoint)
    found = r.spark.read.schema("pedido long, momento timestamp, rechazado boolean").parquet(out)
    return found.select(F.col("pedido").alias("event_id"), "rechazado")


@query("t_3_state", f"SELECT event_id, rechazado FROM ({REVOKED_SQL}) JOIN events USING (event_id) WHERE {CLOSED}")
def t_3_state(r):
    return verdicts(r, "revoked-state", 1, False)


@query(
    "t_4_stream",
    f"""SELECT event_id, EXISTS (SELECT 1 FROM events v WHERE v.event_type = 'error' AND v.user_id = e.user_id AND v.ts <= e.ts
        AND e.ts < v.ts + INTERVAL 12 HOUR AND e.ts - INTERVAL 6 HOUR < v.ts) AS rechazado FROM events e WHERE event_type <> 'error' AND {CLOSED}""",
)
def t_4_stream(r):
    """Every error revokes the tokens that its user was given before it."""
    return verdicts(r, "mass-state", 12, True)


@query(
    "t_4",
    """WITH m AS (SELECT user_id, max(ts) AS marca FROM events WHERE event_type = 'error' GROUP BY user_id)
       SELECT e.event_id, coalesce(m.marca <= e.ts AND e.ts < m.marca + INTERVAL 12 HOUR AND e.ts - INTERVAL 6 HOUR < m.marca, false) AS rechazado
       FROM events e LEFT JOIN m ON e.user_id = m.user_id WHERE e.event_type <> 'error'""",
)
def t_4(r):
    events = r.table("events")
    last = events.filter("event_type = 'error'").groupBy("user_id").agg(F.max("ts").alias("marca"))
    marks = with_expiry(last, "marca", 12 * 3600).select("user_id", "marca", "set_at", "expires_at")
    tokens = events.filter("event_type <> 'error'").withColumn("iat", F.col("ts") - F.expr("interval 6 hours"))
    return access.mass_revoked(tokens, marks).select("event_id", "rechazado")


@query("t_5", "SELECT query_texto, count(*) AS score FROM busqueda GROUP BY query_texto")
def t_5(r):
    out, checkpoint = places(r, "popularity")
    queries = stream(r, "events").select(F.concat(F.lit("tema "), F.get_json_object("props", "$.k")).alias("query_texto"))
    jobs.popularity_counter(queries, out, checkpoint)
    return jobs.running_scores(r.spark, out)


def arrivals_by_kind(r):
    """The events as a stream in which every kind is a micro-batch."""
    path = scratch_path(r.spark, "arrivals")
    kinds = sorted(x[0] for x in r.table("events").select("event_type").distinct().collect())
    for kind in kinds:  # files are taken in the order of their times
        r.table("events").filter(F.col("event_type") == kind).coalesce(1).write.mode("append").parquet(path)
    return jobs.event_stream(r.spark, path, TABLES["events"], "*.parquet", 1)


@query("t_5_fold", "SELECT query_texto, count(*) AS score FROM busqueda GROUP BY query_texto")
def t_5_fold(r):
    """Popularity by day in a sink that folds itself: each day has two folders at most."""
    root, checkpoint = places(r, "popularity-fold")
    queries = arrivals_by_kind(r).select("ts", F.concat(F.lit("tema "), F.get_json_object("props", "$.k")).alias("query_texto"))
    folding.fold_counts(queries, root, checkpoint, ["query_texto"], F.col("ts"), most=3)
    by_day = folding.folded(r.spark, root, T.StructType([T.StructField("query_texto", T.StringType())]))
    return by_day.groupBy("query_texto").agg(F.sum("n").alias("score"))


@query(
    "t_1_fold",
    "SELECT user_id, CAST(ts AS DATE) AS dia, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 6 FROM events) GROUP BY ALL",
)
def t_1_fold(r):
    """Requests per user and day of the last seven days; earlier days have expired."""
    root, checkpoint = places(r, "requests-fold")
    folding.fold_counts(arrivals_by_kind(r), root, checkpoint, ["user_id"], F.col("ts"), most=3, keep_days=6)
    return folding.folded(r.spark, root, T.StructType([TABLES["events"]["user_id"]])).select("user_id", "dia", "n")


@query(
    "t_6",
    f"""SELECT event_id, CASE WHEN ts <= TIMESTAMP '{NOON}' AND TIMESTAMP '{NOON}' < ts + INTERVAL 6 HOUR
          THEN CAST(floor(epoch(ts + INTERVAL 6 HOUR)) AS BIGINT) - CAST(epoch(TIMESTAMP '{NOON}') AS BIGINT) ELSE -2 END AS segundos FROM events""",
)
def t_6(r):
    keys = with_expiry(r.table("events"), "ts", 6 * 3600)
    return keys.select("event_id", seconds_left(F.lit(NOON).cast("timestamp")).alias("segundos"))


@query(
    "t_7",
    f"SELECT event_id, user_id FROM events WHERE event_type = 'signup' AND ts <= TIMESTAMP '{NOON}' AND TIMESTAMP '{NOON}' < ts + INTERVAL 3600 SECOND",
)
def t_7(r):
    logins = access.login_sessions(r.table("events").filter("event_type = 'signup'"), 3600, "ts")
    return live_at(logins, F.lit(NOON).cast("timestamp")).select("event_id", "user_id")


SESSIONS_SQL = """WITH e AS (SELECT *, ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR AS brk FROM events),
    s AS (SELECT *, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM e)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS inicio, strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS fin, count(*) AS eventos
    FROM s GROUP BY user_id, sid"""


def session_rows(df):
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select("user_id", stamp("inicio"), stamp("fin"), "eventos")


@query("t_8", SESSIONS_SQL)
def t_8(r):
    return session_rows(access.gap_sessions(r.table("events"), "6 hours"))


@query("t_8_hash", "SELECT session_hash, count(*) AS busquedas FROM busqueda GROUP BY session_hash")
def t_8_hash(r):
    return r.busqueda.groupBy("session_hash").agg(F.count("*").alias("busquedas"))


@query(
    "t_8_stream",
    f"SELECT * FROM ({SESSIONS_SQL}) WHERE fin <= (SELECT strftime(max(ts) - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') FROM events)",
)
def t_8_stream(r):
    out, checkpoint = places(r, "sessions")
    sessions = jobs.stream_sessions(stream(r, "events"), "1 hour", "6 hours")
    jobs.run(sessions, out, checkpoint)  # sessions are given out once the watermark has passed their end
    return session_rows(stored(r, out, sessions))


def views_stream(r):
    lines = stream(r, "lineitem").filter("l_returnflag = 'N'")
    return lines.select(F.col("l_orderkey").alias("id_documento"), F.col("l_shipdate").alias("created_at"))


@query("t_9", "SELECT * FROM fact_interaccion_documento WHERE id_tipo_interaccion = 2")
def t_9(r):
    out, checkpoint = places(r, "rollup")
    jobs.daily_rollup(views_stream(r), VIEW, out, checkpoint)
    return jobs.daily_fact(r.spark, out)


@query("t_9_fold", "SELECT * FROM fact_interaccion_documento WHERE id_tipo_interaccion = 2")
def t_9_fold(r):
    """The daily fact from a sink that folds itself."""
    root, checkpoint = places(r, "rollup-fold")
    views = views_stream(r)
    folding.fold_counts(views, root, checkpoint, ["id_documento"], F.col("created_at"), grain="month")
    by_day = folding.folded(r.spark, root, T.StructType([views.schema["id_documento"]]))
    return by_day.select(F.col("dia").alias("fecha"), "id_documento", F.lit(VIEW).alias("id_tipo_interaccion"), F.col("n").alias("cant_interacciones"))


@query("t_9_author", "SELECT * FROM fact_interaccion_autor WHERE id_tipo_interaccion = 2")
def t_9_author(r):
    out, checkpoint = places(r, "rollup-author")
    jobs.daily_rollup(views_stream(r), VIEW, out, checkpoint)
    return jobs.daily_author_fact(r.spark, out, r.bridge)


@query("t_10", f"SELECT event_type, count(*) AS tardias FROM events WHERE ts <= TIMESTAMP '{NOON}' GROUP BY event_type")
def t_10(r):
    late = access.late_rows(r.table("events"), "ts", F.lit(NOON).cast("timestamp"))
    return late.groupBy("event_type").agg(F.count("*").alias("tardias"))


@query(
    "t_10_stream",
    """WITH arrivals AS (SELECT *, dense_rank() OVER (ORDER BY event_type) - 1 AS b FROM events),
            marks AS (SELECT b, max(max(ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 1 HOUR AS mark FROM arrivals GROUP BY b)
       SELECT count(*) AS entradas, count(*) FILTER (WHERE ts <= mark) AS tardias, count(*) FILTER (WHERE mark IS NULL OR ts > mark) AS unicas
       FROM arrivals JOIN marks USING (b)""",
)
def t_10_stream(r):
    """Events that arrive kind by kind, each kind a micro-batch: rows behind the watermark are dropped and counted batch by batch.

    A batch drops what is behind the watermark that the batch before it ran with, which is made of those before that one.
    """
    out, checkpoint = places(r, "late")
    once = jobs.stream_deduplicated(arrivals_by_kind(r), "1 hour")
    jobs.run(once, out, checkpoint, metrics=f"{out}-metrics")
    sums = jobs.batch_metrics(r.spark, f"{out}-metrics").agg(F.sum("entradas").alias("entradas"), F.sum("tardias").alias("tardias"))
    return sums.withColumn("unicas", stored(r, out, once).agg(F.count("*").alias("n")).scalar())


@query("t_11", "SELECT event_id, event_type FROM events")
def t_11(r):
    twice = r.table("events").unionByName(r.table("events"))
    return access.deduplicated(twice).select("event_id", "event_type")


@query("t_11_stream", "SELECT event_id, event_type FROM events")
def t_11_stream(r):
    out, checkpoint = places(r, "dedup")
    twice = stream(r, "events").unionByName(stream(r, "events"))
    once = jobs.stream_deduplicated(twice, "1 hour").select("event_id", "event_type")
    jobs.run(once, out, checkpoint)
    return stored(r, out, once)
