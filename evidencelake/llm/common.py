"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidencelake.operators.stashes import clear, shared_dir, stash  # noqa: F401

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Words are maximal runs of characters outside this class, in every operator.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def nested_position(value: Column, bounds: Sequence[int], fan: int = 64) -> Column:
    """How many of the sorted ``bounds`` are <= ``value``, found in two short scans instead of one long one."""
    if not bounds:
        return F.lit(0)
    groups = [list(bounds[i : i + fan]) for i in range(0, len(bounds), fan)]
    firsts = F.array(*[F.lit(g[0]).cast("long") for g in groups])
    tables = F.array(*[F.array(*[F.lit(x).cast("long") for x in g]) for g in groups])
    count = lambda a: F.size(F.filter(a, lambda x: x <= value))
    group = count(firsts)
    return F.when(group == 0, 0).otherwise((group - 1) * fan + count(F.get(tables, group - 1)))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"_{name}"
    return name
