"""Scored members, keys with expiry and nested configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.contracts import INT, TEXT, struct

CONFIG_SCHEMA = T.StructType(
    [
        T.StructField(
            "autocomplete",
            T.StructType(
                [T.StructField("key", TEXT), T.StructField("queries", T.ArrayType(struct(("text", TEXT), ("score", INT))))]
            ),
        ),
        T.StructField(
            "sessions",
            T.StructType(
                [
                    T.StructField("ttl_seconds", INT),
                    T.StructField(
                        "users",
                        T.ArrayType(
                            struct(("user_id", INT), ("session_id", TEXT), ("nombre", TEXT), ("rol", TEXT), ("carrera", TEXT))
                        ),
                    ),
                ]
            ),
        ),
        T.StructField(
            "jwt_blacklist",
            T.StructType(
                [
                    T.StructField("key_prefix", TEXT),
                    T.StructField(
                        "revoked",
                        T.ArrayType(struct(("jti", TEXT), ("user_id", INT), ("ttl_seconds", INT), ("reason", TEXT))),
                    ),
                ]
            ),
        ),
        T.StructField(
            "rate_limit",
            T.StructType(
                [
                    T.StructField("key_prefix", TEXT),
                    T.StructField("window_seconds", INT),
                    T.StructField("limit_per_minute", INT),
                    T.StructField("preloaded", T.ArrayType(struct(("user_id", INT), ("count", INT), ("note", TEXT)))),
                ]
            ),
        ),
    ]
)


def load_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).json(path)


def explode_structs(config: DataFrame, path: str, *carry: Column | str) -> DataFrame:
    """Rows of a nested array of structs, with the carried columns in front."""
    return config.select(*carry, F.explode(path).alias("_item")).select(*_names(carry), "_item.*")


def _names(carry) -> list[str]:
    return [c.split(".")[-1] if isinstance(c, str) else c._jc.toString() for c in carry]


def score_snapshot(scores: DataFrame, member: str = "member", score: str = "score") -> DataFrame:
    """Members by falling score; equal scores in reverse order of the member."""
    return scores.orderBy(F.col(score).desc_nulls_last(), F.col(member).desc_nulls_last())


def live_at(keys: DataFrame, moment: Column, set_at: str = "set_at", expires_at: str = "expires_at") -> DataFrame:
    """Keys that are alive at ``moment``: from the time they were set, until just before they expire."""
    return keys.filter((F.col(set_at) <= moment) & (moment < F.col(expires_at)))


def seconds_left(moment: Column, set_at: str = "set_at", expires_at: str = "expires_at") -> Column:
    """Seconds a key still lives, -2 if it is absent at ``moment``."""
    alive = (F.col(set_at) <= moment) & (moment < F.col(expires_at))
    return F.when(alive, F.unix_timestamp(F.col(expires_at)) - F.unix_timestamp(moment)).otherwise(F.lit(-2))


def with_expiry(rows: DataFrame, set_at: str, ttl_seconds: int | Column) -> DataFrame:
    """Give every row the time it expires at."""
    ttl = ttl_seconds if isinstance(ttl_seconds, Column) else F.lit(ttl_seconds)
    return rows.withColumn("set_at", F.col(set_at)).withColumn(
        "expires_at", F.timestamp_add("SECOND", ttl.cast("int"), F.col(set_at))
    )
