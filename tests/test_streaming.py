"""Streams of files against what a batch run over the same rows gives."""

import datetime as dt
import uuid

import pytest

from evidencelake.streaming import operators as ops

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture
def stream(spark, tmp_path):
    def make(rows, schema):
        folder = str(tmp_path / uuid.uuid4().hex)
        batch = spark.createDataFrame(rows, schema)
        batch.coalesce(1).write.parquet(folder)
        return spark.readStream.schema(batch.schema).parquet(folder)

    return make


def run(df, tmp_path, mode="append"):
    name = "q" + uuid.uuid4().hex
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.sql(f"select * from {name}").collect()


def test_arrivals_once(stream, tmp_path):
    df = stream([("a", at(0)), ("a", at(5)), ("b", at(6))], "chunk_id string, ts timestamp")
    assert sorted(r["chunk_id"] for r in run(ops.arrivals_once(df), tmp_path)) == ["a", "b"]


def test_coverage(spark, stream, tmp_path):
    df = stream([("s", "a", at(0)), ("s", "b", at(5))], "sk string, chunk_id string, ts timestamp")
    expected = spark.createDataFrame([("s", 3)], "sk string, n_expected bigint")
    assert [(r["n_covered"], r["n_holes"]) for r in run(ops.coverage(df, expected, ["sk"]), tmp_path, "update")] == [(2, 1)]


def test_session_episodes(stream, tmp_path):
    rows = [("s", at(0), 10_000), ("s", at(32), 1_000), ("s", at(56), 1_000), ("s", at(5000), 0)]
    df = stream(rows, "sk string, ts timestamp, length_ms bigint")
    got = [(r["t0"].timestamp(), r["t1"].timestamp(), r["n_hits"]) for r in run(ops.session_episodes(df, ["sk"]), tmp_path)]
    base = T0.timestamp()
    assert sorted(got)[:2] == [(base, base + 33, 2), (base + 56, base + 57, 1)]


def test_risk_buckets(stream, tmp_path):
    df = stream([("s", at(1), 5), ("s", at(29), 9), ("s", at(31), 4), ("s", at(9999), 1)], "sk string, ts timestamp, score_milli bigint")
    assert sorted((r["score_milli"], r["n"]) for r in run(ops.risk_buckets(df, ["sk"]), tmp_path))[:2] == [(4, 1), (9, 2)]


def test_follow_stream(stream, tmp_path):
    a = stream([("s", at(0)), ("s", at(100))], "sk string, ts timestamp")
    b = stream([("s", at(15)), ("s", at(116)), ("t", at(1))], "sk string, b_ts timestamp")
    assert [(r["ts"].timestamp(), r["b_ts"].timestamp()) for r in run(ops.follow_stream(a, b, ["sk"]), tmp_path)] == [(T0.timestamp(), T0.timestamp() + 15)]


def test_union_length_function(spark):
    ops.register(spark)
    spark.createDataFrame([(1, 0, 10), (1, 5, 20), (1, 30, 30), (2, 3, 8)], "sk int, start_ms bigint, end_ms bigint").createOrReplaceTempView("iv_test")
    got = spark.sql("select * from union_length_ms(table(iv_test) partition by sk)").collect()
    assert sorted(r["union_ms"] for r in got) == [5, 20]


def test_typing_sessions(stream, tmp_path):
    rows = [("s", "e1", at(0), "ab"), ("s", "e1", at(1), "abcd"), ("s", "e1", at(2), "abc"), ("s", "e2", at(40_000), "x"), ("s", "e3", at(80_000), "y")]
    df = stream(rows, "sk string, element string, ts timestamp, text string")
    got = {r["element"]: (r["n_edits"], r["inserted"], r["peak"]) for r in run(ops.typing_sessions(df), tmp_path)}
    assert got["e1"] == (3, 4, 4)
