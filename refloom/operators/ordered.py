"""Operators that depend on the order of lines or references; order is always an explicit column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import YEAR


def segments(lines: DataFrame, is_start: Column, keys: list[str], order: str) -> DataFrame:
    """lines with `segment`: how many start lines there are up to the line; 0 before the first."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("segment", F.sum(F.when(is_start, 1).otherwise(0)).over(w))


def assemble(lines: DataFrame, is_start: Column, text: str, keys: list[str], order: str, glue: str = " ") -> DataFrame:
    """One row a segment: its lines joined in order. Lines before the first start are left out."""
    held = segments(lines, is_start, keys, order).where("segment > 0").groupBy(*keys, "segment").agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("l"))
    return held.select(*keys, F.col("segment").alias("item_num"), F.array_join(F.transform("l", lambda x: x["t"]), glue).alias(text))


def carry_forward(rows: DataFrame, value: str, keys: list[str], order: str, breaks: Column | None = None) -> DataFrame:
    """rows with nulls of `value` filled from the last row before that has one, not across rows where `breaks` holds."""
    own = Window.partitionBy(*keys, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = segments(rows, F.coalesce(breaks, F.lit(False)) if breaks is not None else F.lit(False), keys, order).withColumnRenamed("segment", "_island")
    return marked.withColumn(value, F.last(value, ignorenulls=True).over(own)).drop("_island")


def inherit_authors(rows: DataFrame, text: str, keys: list[str], order: str, placeholder: str = "---") -> DataFrame:
    """References that start with a placeholder take the text before the year from the nearest reference before that has none.

    The chain is exact: a run of placeholders all take from the same head; a head whose year is at its end, or that has
    none, gives nothing. In one window pass.
    """
    mine = F.col(text).startswith(placeholder)
    head = F.regexp_extract(F.col(text), rf"^(.*?)\(?{YEAR}\)?\W*\w", 1)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    given = F.last(F.when(~mine, head), ignorenulls=True).over(w)
    filled = F.concat(F.trim(given), F.lit(" "), F.trim(F.substring(F.col(text), F.lit(len(placeholder) + 1), F.length(text))))
    return rows.withColumn("_given", given).withColumn(text, F.when(mine & (F.coalesce(F.col("_given"), F.lit("")) != ""), filled).otherwise(F.col(text))).drop("_given")


def number_items(refs: DataFrame, keys: list[str], order: str) -> DataFrame:
    return refs.withColumn("item_num", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def bag_difference(tokens: Column, used: Column) -> Column:
    """tokens without one occurrence for each used value."""

    def drop_one(rest: Column, value: Column) -> Column:
        at = F.array_position(rest, value).cast("int")
        return F.when(at > 0, F.concat(F.slice(rest, F.lit(1), at - 1), F.slice(rest, at + 1, F.greatest(F.size(rest) - at, F.lit(0))))).otherwise(rest)

    return F.aggregate(used, tokens, drop_one)
