"""Rate limits, token revocation and sessions over event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmart.operators.ranking import top_k_per_group
from scholarmart.sources.keyvalue import with_expiry


def window_start(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / seconds) * seconds


def rate_limit(
    requests: DataFrame,
    limit: int,
    seconds: int = 60,
    user: str = "user_id",
    ts: str = "ts",
    key: str = "event_id",
    starting: DataFrame | None = None,
) -> DataFrame:
    """Verdict per request: the first ``limit`` of a user in a fixed window are accepted.

    Only the accepted requests of a window are ordered, and the limit is applied in
    every task before the shuffle; the last accepted one is the cut that every
    request is compared with. A flooding user therefore never gathers in one task.
    ``starting`` holds ``user, ventana, n``: requests already counted.
    """
    placed = requests.withColumn("ventana", window_start(ts, seconds))
    order = [F.col(ts).asc(), F.col(key).asc()]
    first = top_k_per_group(placed.select(user, "ventana", ts, key), [user, "ventana"], limit, order, "_n")
    if starting is not None:
        used = starting.select(user, "ventana", F.col("n").alias("_used"))
        first = first.join(used, [user, "ventana"], "left").filter(F.col("_n") + F.coalesce("_used", F.lit(0)) <= limit)
    cut = first.groupBy(user, "ventana").agg(F.max(F.struct(F.col(ts).alias("t"), F.col(key).alias("k"))).alias("_cut"))
    joined = placed.join(cut, [user, "ventana"], "left")
    mine = F.struct(F.col(ts).alias("t"), F.col(key).alias("k"))
    return joined.withColumn("aceptado", F.coalesce(mine <= F.col("_cut"), F.lit(False))).drop("_cut")


def window_counts(requests: DataFrame, seconds: int = 60, user: str = "user_id", ts: str = "ts") -> DataFrame:
    return requests.groupBy(user, window_start(ts, seconds).alias("ventana")).agg(F.count("*").alias("n"))


def sliding_counts(requests: DataFrame, seconds: int, user: str = "user_id", ts: str = "ts", key: str = "event_id") -> DataFrame:
    """Requests of the same user in the last ``seconds`` seconds, up to and with each request.

    Requests are counted per second first, in every task before the shuffle; the window slides over these counts. Time is cut into pieces of
    ``seconds`` seconds, and a count also goes to the following piece, where it is added but not returned; so a window sees
    at most twice ``seconds`` rows, however busy a user is.
    """
    second = F.unix_timestamp(F.col(ts).cast("timestamp"))
    placed = requests.select(user, ts, key, second.alias("_s"))
    piece = F.floor(F.col("_s") / seconds)
    copies = F.explode(F.array(*[F.struct((piece + d).alias("_piece"), F.lit(d == 0).alias("_own")) for d in (0, 1)])).alias("_p")
    counted = placed.groupBy(user, "_s").agg(F.count("*").alias("_n")).select(user, "_s", "_n", copies).select(user, "_s", "_n", "_p.*")
    w = Window.partitionBy(user, "_piece").orderBy("_s").rangeBetween(-(seconds - 1), 0)
    slid = counted.withColumn("n", F.sum("_n").over(w)).filter("_own").select(F.col(user).alias("_user"), F.col("_s").alias("_at"), "n")
    return placed.join(slid, F.col(user).eqNullSafe(F.col("_user")) & (F.col("_s") == F.col("_at"))).select(user, ts, key, "n")


def revoked(requests: DataFrame, revocations: DataFrame, token: str, ts: str = "ts") -> DataFrame:
    """Flag requests whose token was revoked at that time; revocations hold ``token, set_at, expires_at``.

    Equal tokens meet in pieces of time, so a hot token spreads over tasks. Overlapping revocations of a piece are merged first and travel
    as one row, so requests are read and joined once and never multiplied.
    """
    width = 3600
    piece = lambda c: F.floor(F.unix_timestamp(c) / width)
    spans = revocations.filter((F.col("set_at") < F.col("expires_at")) & F.col(token).isNotNull()).select(
        F.col(token).alias("_token"), F.col("set_at").alias("_from"), F.col("expires_at").alias("_to"), F.explode(F.sequence(piece(F.col("set_at")), piece(F.col("expires_at")))).alias("_span")
    )
    before = Window.partitionBy("_token", "_span").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("_from") > F.max("_to").over(before), F.lit(True))
    island = F.sum(apart.cast("int")).over(Window.partitionBy("_token", "_span").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, 0))
    merged = spans.distinct().withColumn("_island", island).groupBy("_token", "_span", "_island").agg(F.min("_from").alias("a"), F.max("_to").alias("b"))
    lists = merged.groupBy("_token", "_span").agg(F.collect_list(F.struct("a", "b")).alias("_spans"))  # disjoint
    asked = requests.withColumn("_piece", piece(F.col(ts).cast("timestamp")))
    both = asked.join(lists, (F.col(token) == F.col("_token")) & (F.col("_piece") == F.col("_span")), "left")
    hit = F.exists("_spans", lambda s: (s["a"] <= F.col(ts)) & (F.col(ts) < s["b"]))
    return both.withColumn("rechazado", F.coalesce(hit, F.lit(False))).select(*requests.columns, "rechazado")


def mass_revoked(tokens: DataFrame, marks: DataFrame, user: str = "user_id", issued: str = "iat", ts: str = "ts") -> DataFrame:
    """Flag tokens issued before their user's mark, while the mark lives. Marks hold ``user, marca, set_at, expires_at``."""
    # the few marks of a user travel as one row, so several live ones do not multiply the requests
    per_user = marks.groupBy(user).agg(F.collect_list(F.struct("marca", "set_at", "expires_at")).alias("_marks"))
    hit = lambda m: (m["set_at"] <= F.col(ts)) & (F.col(ts) < m["expires_at"]) & (F.col(issued) < m["marca"])
    return tokens.join(per_user, user, "left").withColumn("rechazado", F.coalesce(F.exists("_marks", hit), F.lit(False))).drop("_marks")


def login_sessions(logins: DataFrame, ttl_seconds: int = 3600, created: str = "created_at") -> DataFrame:
    return with_expiry(logins, created, ttl_seconds)


def gap_sessions(events: DataFrame, gap: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Sessions per user that end after a gap; merged in every task before the shuffle."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        timed.groupBy(user, F.session_window(ts, gap).alias("sesion"))
        .agg(F.count("*").alias("eventos"))
        .select(user, F.col("sesion.start").alias("inicio"), F.col("sesion.end").alias("fin"), "eventos")
    )


def funnel(events: DataFrame, steps: Sequence[str], gap: str, user: str = "user_id", ts: str = "ts", kind: str = "event_type") -> DataFrame:
    """How many sessions reach each step in order, by the first time of every step."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    firsts = timed.groupBy(user, F.session_window(ts, gap).alias("sesion")).agg(
        *[F.min(F.when(F.col(kind) == s, F.col(ts))).alias(f"_t{i}") for i, s in enumerate(steps)]
    )
    reached = F.lit(True)
    counts = []
    for i in range(len(steps)):
        here = F.col(f"_t{i}").isNotNull()
        reached = reached & (here if i == 0 else here & (F.col(f"_t{i}") > F.col(f"_t{i - 1}")))
        counts.append(F.coalesce(F.sum(reached.cast("long")), F.lit(0)).alias(f"paso_{i + 1}"))
    return firsts.agg(F.count("*").alias("sesiones"), *counts)


def transitions(events: DataFrame, session: Sequence[str], ts: str = "ts", key: str = "event_id", kind: str = "event_type") -> DataFrame:
    """How often one kind of event follows another inside a session."""
    w = Window.partitionBy(*session).orderBy(F.col(ts).asc(), F.col(key).asc())
    steps = events.withColumn("siguiente", F.lead(kind).over(w)).filter(F.col("siguiente").isNotNull())
    return steps.groupBy(F.col(kind).alias("paso"), "siguiente").agg(F.count("*").alias("veces"))


def deduplicated(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Replayed events count once."""
    return events.dropDuplicates([key])


def late_rows(events: DataFrame, ts: str, watermark: Column) -> DataFrame:
    """Rows an additive load will never see because they are not after the mark."""
    return events.filter(F.col(ts) <= watermark)
