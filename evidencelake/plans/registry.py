"""Registered queries with their oracle SQL, and the bindings of the test tables to session tables.

Binding E (events): a session is a user; ``ord`` is the event id, ``k`` the number in ``props``, ``t_ms`` the epoch millisecond.
Binding I (intervals): the same rows as spans of ``value`` hours.  The oracle's common table expressions mirror both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR = 3_600_000
N = 6 * HOUR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

EV = """ev AS (SELECT user_id AS sk, event_id AS ord, event_type AS kind, value,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, epoch_us(ts) // 1000 AS t_ms FROM events),
iv AS (SELECT *, t_ms AS start_ms, t_ms + CAST(floor(value * 3600000) AS BIGINT) AS end_ms FROM ev)"""


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame; ``sql`` may use the tables ev and iv."""

    def note(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            body = sql.strip()
            ORACLES[key] = f"WITH RECURSIVE {EV}{',' if body.startswith('+') else ''} {body.removeprefix('+').strip()}"
        return f

    return note


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 1000")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    rows = table(spark, sf_dir, "events")
    return rows.select(
        F.col("user_id").alias("sk"), F.col("event_id").alias("ord"), F.col("event_type").alias("kind"), "value", k.alias("k"), t.alias("t_ms")
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.col("t_ms") + F.floor(F.col("value") * HOUR).cast("bigint")
    return events(spark, sf_dir).withColumn("start_ms", F.col("t_ms")).withColumn("end_ms", end)


def of_kind(df: DataFrame, *kinds: str) -> DataFrame:
    return df.filter(F.col("kind").isin(*kinds))
