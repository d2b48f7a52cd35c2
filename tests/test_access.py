import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scholarmart.operators import access
from scholarmart.sources.keyvalue import live_at, seconds_left, with_expiry
from tests.conftest import utc


def at(second, minute=0):
    return utc(2026, 5, 18, 14, minute) + dt.timedelta(seconds=second)


def test_rate_limit_on_top_of_a_count(spark):
    requests = spark.createDataFrame([(1, 1002, at(1)), (2, 1002, at(2)), (3, 1002, at(3)), (4, 1002, at(1, 1))], "event_id int, user_id int, ts timestamp")
    start = int(at(0).timestamp())
    used = spark.createDataFrame([(1002, start, 28)], "user_id int, ventana long, n long")
    out = access.rate_limit(requests, 30, starting=used)
    assert {r["event_id"]: r["aceptado"] for r in out.collect()} == {1: True, 2: True, 3: False, 4: True}


def test_rate_limit_31st_is_rejected(spark):
    requests = spark.createDataFrame([(i, 7, at(i)) for i in range(1, 41)], "event_id int, user_id int, ts timestamp")
    out = access.rate_limit(requests, 30).collect()
    assert {r["event_id"] for r in out if r["aceptado"]} == set(range(1, 31))


def test_rate_limit_plan_orders_only_accepted(spark):
    requests = spark.createDataFrame([(1, 7, at(1))], "event_id int, user_id int, ts timestamp")
    plan = access.rate_limit(requests, 30)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sliding_window_sees_across_pieces(spark):
    requests = spark.createDataFrame([(1, 7, at(50)), (2, 7, at(70)), (3, 7, at(115)), (4, 8, at(70))], "event_id int, user_id int, ts timestamp")
    out = {r["event_id"]: r["n"] for r in access.sliding_counts(requests, 60).collect()}
    assert out == {1: 1, 2: 2, 3: 2, 4: 1}


def test_ttl(spark):
    keys = with_expiry(spark.createDataFrame([("k", at(0))], "key string, t timestamp"), "t", 5)
    left = [keys.select(seconds_left(F.lit(at(s)))).first()[0] for s in (4, 5, 6)]
    assert left == [1, -2, -2]
    assert [live_at(keys, F.lit(at(s))).count() for s in (0, 4, 5)] == [1, 1, 0]


def test_mass_revocation(spark):
    tokens = spark.createDataFrame([(1, 1002, utc(2026, 5, 18, 14, 24, 59), at(0, 30)), (2, 1002, utc(2026, 5, 18, 14, 25), at(0, 30))], "id int, user_id int, iat timestamp, ts timestamp")
    mark = with_expiry(spark.createDataFrame([(1002, utc(2026, 5, 18, 14, 25))], "user_id int, marca timestamp"), "marca", 1800)
    out = access.mass_revoked(tokens, mark)
    assert {r["id"]: r["rechazado"] for r in out.collect()} == {1: True, 2: False}


@pytest.mark.parametrize("second, rejected", [(-1, False), (0, True), (1799, True), (1800, False)])
def test_revocation_lives_for_its_ttl(spark, second, rejected):
    revocations = with_expiry(spark.createDataFrame([("j", at(0, 25))], "jti string, t timestamp"), "t", 1800).drop("t")
    requests = spark.createDataFrame([(1, "j", at(second, 25)), (2, "other", at(second, 25))], "id int, jti string, ts timestamp")
    out = {r["id"]: r["rechazado"] for r in access.revoked(requests, revocations, "jti").collect()}
    assert out == {1: rejected, 2: False}


def test_overlapping_revocations_keep_one_row(spark):
    revocations = with_expiry(spark.createDataFrame([("j", at(0)), ("j", at(10))], "jti string, t timestamp"), "t", 60).drop("t")
    requests = spark.createDataFrame([(1, "j", at(20))], "id int, jti string, ts timestamp")
    assert access.revoked(requests, revocations, "jti").count() == 1


def test_overlapping_revocations_and_busy_tokens(spark):
    rng = random.Random(2)
    marks = [(rng.choice(["a", "b", None]), at(s := rng.randrange(20_000)), at(s + rng.choice([0, 5, 900, 9000]))) for _ in range(60)]
    asked = [(i, rng.choice(["a", "a", "b", "c", None]), at(rng.randrange(30_000))) for i in range(400)] + [(1, "a", at(5))]
    revocations = spark.createDataFrame(marks, "jti string, set_at timestamp, expires_at timestamp")
    out = access.revoked(spark.createDataFrame(asked, "id int, jti string, ts timestamp"), revocations, "jti").collect()
    wanted = sorted((i, str(j), any(j == k and a <= t < b for k, a, b in marks if k)) for i, j, t in asked)
    assert sorted((r.id, str(r.jti), r.rechazado) for r in out) == wanted and out[0].asDict().keys() == {"id", "jti", "ts", "rechazado"}


def test_sliding_window_of_busy_seconds(spark):
    rng = random.Random(3)
    asked = [(i, rng.choice([7, 7, 8, None]), at(rng.randrange(300))) for i in range(500)]
    out = access.sliding_counts(spark.createDataFrame(asked, "event_id int, user_id int, ts timestamp"), 60).collect()
    wanted = {i: sum(v == u and 0 <= (t - s).total_seconds() < 60 for _, v, s in asked) for i, u, t in asked}
    assert len(out) == 500 and {r.event_id: r.n for r in out} == wanted
