"""Ordered lists per group, in stretches, for the text exports that put a group on one line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cutgrid.functions.sizing import measured, small, stage
from cutgrid.operators.numbering import ranked

#: Rows of a group that one list holds.
LIST_ROWS = 200_000


def _collect(rows: DataFrame, keys: Sequence[str], items: Sequence[str], order: Sequence[str]) -> DataFrame:
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, *items))).alias("_entries"))
    return lists.select(
        *keys, F.size("_entries").cast("long").alias("_size"), *[F.col(f"_entries.{item}").alias(item) for item in items]
    )


def ordered_lists(
    df: DataFrame, keys: Sequence[str], items: Sequence[str], order: Sequence[Column], max_rows: int = LIST_ROWS
) -> DataFrame:
    """A group's `items` as lists in `order`, one row per `max_rows` consecutive rows of the group.

    `chunk` numbers the rows of a group from 0, by exact rank; `n` is the size of the whole group on each of them. Only
    groups above `max_rows` need ranks, so the others are collected directly, with the same result. `order` must tell
    the rows of a group apart. `df` is evaluated once.
    """
    names = [f"_k{i}" for i in range(len(order))]
    rows = stage(df.select(*keys, *items, *[column.alias(name) for name, column in zip(names, order)]))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    large, groups, _ = measured(counts.filter(F.col("_rows") > max_rows))
    columns = [*keys, F.col("_size").alias("n"), *items, F.lit(0).cast("long").alias("chunk")]
    if not groups:
        return _collect(rows, keys, items, names).select(*columns)
    large = small(large.drop("_rows"))
    cut = ranked(rows.join(large, list(keys), "left_semi"), keys, names).withColumn(
        "chunk", F.floor(F.col("rank") / F.lit(max_rows)).cast("long")
    )
    return _collect(rows.join(large, list(keys), "left_anti"), keys, items, names).select(*columns).unionByName(
        _collect(cut, [*keys, "chunk", "n"], items, names).drop("_size")
    )
