"""Comparison of the resolver's answers with those of the classic resolver."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import HIDDEN_STATES, STATES, UNRESOLVED


def compare_state(service: Column, classic: Column, score: Column) -> Column:
    """State of a pair by the classic score (5, 1 or 0, as text) and what the service found; other scores: null."""
    found = service != UNRESOLVED
    return (
        F.when(score == "5", F.when(found, "NEWU").otherwise("UNVER"))
        .when(score == "1", F.when(F.upper(classic) == F.upper(service), "MATCH").when(found, "DIFF").otherwise("MISS"))
        .when(score == "0", F.when(found, "NEW").otherwise("NONE"))
    )


def positional_compare(service: DataFrame, classic: DataFrame) -> DataFrame:
    """Pairs by position within blocks whose sides have equally many rows. service: (block, pos, bibcode); classic: (block, pos, bibcode, score)."""
    n_service, n_classic = (d.groupBy("block").agg(F.count("*").alias(n)) for d, n in ((service, "n_s"), (classic, "n_c")))
    even = n_service.join(n_classic, "block").where("n_s = n_c").select("block")
    s = service.select("block", "pos", F.col("bibcode").alias("service_bibcode"))
    c = classic.select("block", "pos", F.trim("bibcode").alias("classic_bibcode"), F.col("score").alias("classic_score"))
    paired = s.join(c, ["block", "pos"]).join(even, "block", "left_semi")
    return paired.withColumn("state", compare_state(F.col("service_bibcode"), F.col("classic_bibcode"), F.col("classic_score")))


def greedy_compare(service: DataFrame, classic: DataFrame) -> DataFrame:
    """Pairs within blocks of different sizes: each service row, in order, takes the first classic row not yet taken whose
    text or found bibcode is the same. service: (block, pos, refstring, bibcode); classic: (block, pos, reference, bibcode, score).

    What a row takes depends on all before it, so each block is folded in order; blocks are references of one paper.
    """

    def fold(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        free = list(right.sort_values("pos")[["reference", "bibcode", "score"]].itertuples(index=False, name=None))
        out = []
        for pos, text, bibcode in left.sort_values("pos")[["pos", "refstring", "bibcode"]].itertuples(index=False, name=None):
            text = text or ""
            if text.startswith(" ["):
                text = text[text.find("]") + 1 :]
            hit = next((k for k, (t, b, _) in enumerate(free) if t == text or (b == bibcode and bibcode != UNRESOLVED)), None)
            if hit is not None:
                _, b, score = free.pop(hit)
                out.append((key[0], pos, bibcode, b, score))
        return pd.DataFrame(out, columns=["block", "pos", "service_bibcode", "classic_bibcode", "classic_score"])

    kind = service.schema["block"].dataType.simpleString()
    pairs = service.groupBy("block").cogroup(classic.groupBy("block")).applyInPandas(fold, f"block {kind}, pos long, service_bibcode string, classic_bibcode string, classic_score string")
    return pairs.withColumn("state", compare_state(F.col("service_bibcode"), F.col("classic_bibcode"), F.col("classic_score")))


def runs_named(history: DataFrame, bibcode: str | None = None, filename: str | None = None, match: str = "regex") -> DataFrame:
    """Runs by bibcode, file name or both. match="regex": the table's values are patterns that the arguments are searched
    for, unanchored; "exact": they are equal."""
    for column, value in (("bibcode", bibcode), ("source_filename", filename)):
        if value is not None:
            history = history.where(F.rlike(F.lit(value), F.col(column)) if match == "regex" else F.col(column) == value)
    return history


def compare_tags(history: DataFrame, resolved: DataFrame, compare: DataFrame, bibcode: str | None = None, filename: str | None = None, match: str = "regex", all_states: bool = False) -> DataFrame:
    """A column for each state, holding its name or null, by (history_id, item_num), of the runs that runs_named() finds."""
    if bibcode is None and filename is None:
        raise ValueError("bibcode or filename is needed")
    history = runs_named(history, bibcode, filename, match)
    ids = resolved.join(history.select(F.col("id").alias("history_id")), "history_id").select("history_id", "item_num").distinct()
    states = STATES + HIDDEN_STATES if all_states else STATES
    joined = ids.join(compare.select("history_id", "item_num", "state"), ["history_id", "item_num"])
    return joined.groupBy("history_id", "item_num").agg(*(F.max(F.when(F.col("state") == s, s)).alias(s) for s in states))


GRID_COLUMNS = ("refstr", "service_bibcode", "classic_bibcode", "service_conf", "classic_score", "match", "miss", "new", "newu", "diff")
GRID_WIDTHS = (60, 19, 19, 15, 15, 5, 5, 5, 5, 5)


def compare_grid(history: DataFrame, resolved: DataFrame, compare: DataFrame, **which) -> DataFrame:
    """The rows of the grid, with history_id and item_num to order them by."""
    tags = compare_tags(history, resolved, compare, **which)
    r = resolved.select("history_id", "item_num", F.col("reference_str").alias("refstr"), F.col("bibcode").alias("service_bibcode"), F.col("score").alias("service_conf"))
    c = compare.select("history_id", "item_num", F.col("bibcode").alias("classic_bibcode"), F.col("score").alias("classic_score"))
    return r.join(c, ["history_id", "item_num"]).join(tags, ["history_id", "item_num"]).select("history_id", "item_num", *GRID_COLUMNS[:5], *(F.col(s).alias(s.lower()) for s in STATES))


def grid_totals(grid: DataFrame) -> DataFrame:
    """(num_references, num_resolved): a service bibcode that starts with a dot is not resolved."""
    return grid.agg(F.count("*").alias("num_references"), F.count(F.when(~F.col("service_bibcode").startswith("."), 1)).alias("num_resolved"))


def draw_grid(rows: Iterator[dict], widths: tuple = GRID_WIDTHS) -> str:
    """The grid as text: a header, then a line for each row, cells wrapped to their width, empty for null and 0."""
    rule = lambda c: "+" + "+".join(c * (w + 2) for w in widths) + "+"

    def line(cells: list[str], first_left: bool) -> list[str]:
        wrapped = [[c[i : i + w] for i in range(0, len(c), w)] or [""] for c, w in zip(cells, widths)]
        return ["| " + " | ".join((part[k] if k < len(part) else "").ljust(w) if n == 0 and first_left else (part[k] if k < len(part) else "").center(w) for n, (part, w) in enumerate(zip(wrapped, widths))) + " |" for k in range(max(map(len, wrapped)))]

    out = [rule("-"), *line(list(GRID_COLUMNS), False), rule("=")]
    for row in rows:
        out += [*line([str(row[c]) if row[c] else "" for c in GRID_COLUMNS], True), rule("-")]
    return "\n".join(out)
