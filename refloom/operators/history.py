"""Questions asked of the processing history: best matches, run summaries, diagnostics, candidates for another run."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import bibstem_mask, is_queued, year_mask

#: How much a parser counts in the ranking by priority.
LOW_PRIORITY = ("arXiv", "CrossRef")
HIGH_PRIORITY = ("Arthur",)


def parser_priority(parser: Column, low: tuple = LOW_PRIORITY, high: tuple = HIGH_PRIORITY) -> Column:
    return F.when(parser.isin(*low), 1).when(parser.isin(*high), 3).otherwise(2)


def _sourced(resolved: DataFrame, history: DataFrame, source: DataFrame, strict: bool) -> DataFrame:
    """Resolved references with their run and source; strict joins sources by file as well as by bibcode."""
    r = resolved.where("score <> 0").select("history_id", F.col("item_num").alias("id"), F.col("bibcode").alias("resolved_bibcode"), "score")
    h = history.select(F.col("id").alias("h_id"), F.col("bibcode").alias("h_bibcode"), F.col("source_filename").alias("h_file"), "date")
    s = source.select(F.col("bibcode").alias("source_bibcode"), F.col("source_filename").alias("s_file"), "parser_name")
    on = h["h_bibcode"] == s["source_bibcode"]
    return r.join(h, r["history_id"] == h["h_id"]).join(s, on & (h["h_file"] == s["s_file"]) if strict else on)


def _first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def best_by_parser(resolved: DataFrame, history: DataFrame, source: DataFrame, source_bibcode: str | None = None, strict: bool = False) -> DataFrame:
    """The match of highest score for each source, parser and resolved bibcode; ties go to the later run, then the first item."""
    if source_bibcode is not None:
        source, history = source.where(F.col("bibcode") == source_bibcode), history.where(F.col("bibcode") == source_bibcode)
    found = _first(_sourced(resolved, history, source, strict), ["source_bibcode", "parser_name", "resolved_bibcode"], [F.desc_nulls_first("score"), F.desc("history_id"), F.asc("id"), F.desc("date")])
    return found.select("source_bibcode", "date", "id", "resolved_bibcode", "score", "parser_name")


def best_by_priority(resolved: DataFrame, history: DataFrame, source: DataFrame, source_bibcode: str | None = None, strict: bool = False, ascending: bool = False) -> DataFrame:
    """The match of highest parser priority (lowest if ascending), then score, for each source and resolved bibcode; ties as in best_by_parser()."""
    if source_bibcode is not None:
        source, history = source.where(F.col("bibcode") == source_bibcode), history.where(F.col("bibcode") == source_bibcode)
    ranked = _sourced(resolved, history, source, strict).withColumn("parser_priority", parser_priority(F.col("parser_name")))
    by = F.asc("parser_priority") if ascending else F.desc("parser_priority")
    found = _first(ranked, ["source_bibcode", "resolved_bibcode"], [by, F.desc_nulls_first("score"), F.desc("history_id"), F.asc("id"), F.asc("parser_name"), F.desc("date")])
    return found.select("source_bibcode", "date", "id", "resolved_bibcode", "score", "parser_name", "parser_priority")


def run_summary(history: DataFrame, by: str = "bibcode", bibcodes: list[str] | None = None, filenames: list[str] | None = None) -> DataFrame:
    """Runs, last date and last id of each bibcode, source_filename or id."""
    for column, wanted in (("bibcode", bibcodes), ("source_filename", filenames)):
        if wanted:
            history = history.where(F.col(column).isin(*wanted))
    found = history.groupBy(F.col(by).alias("_key")).agg(F.max("bibcode").alias("bibcode"), F.max("source_filename").alias("source_filename"), F.count("bibcode").alias("num_runs"), F.max("date").alias("last_run_date"), F.max("id").alias("history_id"))
    return found.drop("_key")


def first_runs(history: DataFrame, limit: int = 10) -> DataFrame:
    return run_summary(history.orderBy("id").limit(limit), "id").orderBy("history_id")


def resolved_counts(resolved: DataFrame, history_ids: DataFrame | None = None) -> DataFrame:
    """References and resolved references (score above 0) of each run."""
    if history_ids is not None:
        resolved = resolved.join(history_ids.select("history_id").distinct(), "history_id", "left_semi")
    return resolved.groupBy("history_id").agg(F.count("item_num").alias("last_run_num_references"), F.count(F.when(F.col("score") > 0, F.col("score"))).alias("last_run_num_resolved_references"))


def all_bibcodes(*tables: DataFrame) -> DataFrame:
    """(bibcode) of any of the tables, once each."""
    return reduce(DataFrame.union, (t.select("bibcode").distinct() for t in tables)).distinct()


def diagnostics(source: DataFrame, history: DataFrame, resolved: DataFrame) -> DataFrame:
    """For each bibcode of either table: its first source, its run summary and the counts of its last run; what is missing is null."""
    first = _first(source.select("bibcode", F.col("source_filename").alias("source_file"), "resolved_filename", "parser_name"), ["bibcode"], [F.asc("source_file"), F.asc("parser_name")])
    runs = run_summary(history)
    return first.join(runs, "bibcode", "full").join(resolved_counts(resolved), "history_id", "left").select("bibcode", F.coalesce("source_file", "source_filename").alias("source_filename"), "resolved_filename", "parser_name", "num_runs", "last_run_date", "history_id", "last_run_num_references", "last_run_num_resolved_references")


#: Names and descriptions of the four tables.
TABLE_NOTES = {
    "reference_source": ("ReferenceSource", "source reference file information"),
    "processed_history": ("ProcessedHistory", "top level information for a processed run"),
    "resolved_reference": ("ResolvedReference", "resolved reference information for a processed run"),
    "compare_classic": ("CompareClassic", "comparison of new and classic processed run"),
}


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, description, count) of each table."""
    counts = [df.agg(F.count("*").alias("count")).select(F.lit(TABLE_NOTES[t][0]).alias("name"), F.lit(TABLE_NOTES[t][1]).alias("description"), "count") for t, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out


# Reprocessing --------------------------------------------------------------


def reprocess_filter(kind: str, score_cutoff: float | None = None, match: str | None = None) -> Column:
    """kind: score (at most the cutoff to two places), bibstem, year (masks over the bibcode) or failed (still queued)."""
    if kind == "score":
        return F.col("score") <= F.lit(f"{score_cutoff:.2f}").cast("decimal(10,4)")
    if kind in ("bibstem", "year"):
        if not match:
            return F.lit(True)
        return bibstem_mask(F.col("r_bibcode"), match) if kind == "bibstem" else year_mask(F.col("r_bibcode"), match)
    if kind == "failed":
        return is_queued(F.col("r_bibcode"), F.col("score"))
    raise ValueError(f"no such kind: {kind}")


def reprocess_rows(resolved: DataFrame, history: DataFrame, source: DataFrame, kind: str, score_cutoff: float | None = None, match: str | None = None, days: int | None = None, now: dt.datetime | None = None) -> DataFrame:
    """One row for each reference to process again: filter, joins and projection in one plan."""
    r = resolved.withColumnRenamed("bibcode", "r_bibcode")
    h = history.select(F.col("id").alias("history_id"), F.col("bibcode").alias("source_bibcode"), "source_filename", "source_modified", "date")
    if days:
        since = (now or dt.datetime.now()) - dt.timedelta(days=int(days))
        h = h.where(F.col("date") >= F.lit(since))
    s = source.select(F.col("bibcode").alias("source_bibcode"), "source_filename", "parser_name")
    chosen = r.where(reprocess_filter(kind, score_cutoff, match)).join(h, "history_id").join(s, ["source_bibcode", "source_filename"])
    return chosen.select("history_id", "item_num", F.col("reference_str").alias("refstr"), F.col("reference_raw").alias("refraw"), "source_bibcode", "source_filename", "source_modified", "parser_name")


def reprocess_batches(rows: DataFrame) -> DataFrame:
    """One row a run, its references in order, in the shape that parsers take from a buffer."""
    keys = ["history_id", "source_bibcode", "source_filename", "source_modified", "parser_name"]
    batches = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("item_num", "refstr", "refraw"))).alias("references"))
    return batches.withColumn("block_references", F.array(F.struct("source_bibcode", "references"))).drop("references")
