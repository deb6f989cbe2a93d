"""Ranks and running sums within groups of any size: a group's rows are spread over tasks, and no window sees a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.sources import files

_PART = "_dealt_part"


def running(rows: DataFrame, within: Sequence[str], order: Sequence[Column | str], sums: Mapping[str, Column]) -> DataFrame:
    """``rows`` with a column for each of ``sums``: its sum over the rows of the group up to and with this one.

    Rows are dealt to tasks by ranges of (group, order) and written once, so that the deal can't change under a retry.
    Each task sums its own range; a group that goes over several ranges is given the sums of the ranges before. There is at most one such
    group at each border of two ranges, so what is joined back has no more rows than twice the ranges, whatever the input.

    ``order`` should tell all rows of a group apart; rows that it doesn't are in one range, in any order. Null keys are a group like any other.
    """
    if clash := [c for c in rows.columns if c in {_PART, *sums}]:
        raise ValueError(f"rows has columns of names used here: {clash}")
    spark, own = rows.sparkSession, [f"_sum_{k}" for k in range(len(sums))]
    path = files.shared_dir(spark)
    dealt = rows.withColumns(dict(zip(own, sums.values()))).repartitionByRange(*within, *order).withColumn(_PART, F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)

    parts = dealt.groupBy(_PART, *within).agg(*(F.sum(c).alias(c) for c in own))
    several = parts.groupBy(*within).agg(F.count("*").alias("_n")).where("_n > 1")
    same = lambda a, b, keys: [a[k].eqNullSafe(b[k]) for k in keys]
    parts = parts.join(several, same(parts, several, within), "left_semi")
    before = Window.partitionBy(*within).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col(_PART).alias("_of"), *(F.col(k).alias(f"_key_{k}") for k in within), *(F.sum(c).over(before).alias(f"_before{c}") for c in own))

    so_far = Window.partitionBy(_PART, *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = dealt.withColumns({c: F.sum(c).over(so_far) for c in own})
    met = here.join(F.broadcast(offsets), [here[_PART] == offsets["_of"], *(here[k].eqNullSafe(offsets[f"_key_{k}"]) for k in within)], "left")
    total = {name: (F.col(c) + F.coalesce(F.col(f"_before{c}"), F.lit(0))).alias(name) for name, c in zip(sums, own)}
    return met.select(*rows.columns, *total.values())


def ranked(rows: DataFrame, within: Sequence[str], order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """``rows`` with their number, from 1, within the group."""
    return running(rows, within, order, {name: F.lit(1).cast("bigint")})
