"""Analytics over telemetry events: exact percentiles, throughput, breakdowns, reports."""

from __future__ import annotations

import csv
import io
import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import nonempty, raw_subfamily, source_type
from ..schemas import SYSTEM_METRICS
from .quantiles import exact_percentiles

NOT_STAGES = ("task_timing", "app_timing")
DB_STAGES = ("pre_resolved_db", "post_resolved_db")
UNKNOWN = "unknown"
SMALL = 32 << 20  # bytes of input, by Catalyst's estimate, up to which percentiles are one aggregation
STATS = ("count", "min", "max", "mean", "p50", "p95", "p99")


def stats(value: Column, p99: bool = True) -> dict[str, Column]:
    """count, min, max, mean and exact linear-interpolated percentiles of the non-null values; no values: count 0 and nulls. For windows of a stream; stats_by() for the rest."""
    ranks = [0.5, 0.95, 0.99][: 3 if p99 else 2]
    found = F.percentile(value, F.array(*map(F.lit, ranks)))  # one aggregation for all
    out = {"count": F.count(value), "min": F.min(value), "max": F.max(value), "mean": F.avg(value)}
    return out | {f"p{round(q * 100)}": found[k] for k, q in enumerate(ranks)}


def stat_columns(value: Column, prefix: str = "", p99: bool = True) -> list[Column]:
    return [c.alias(f"{prefix}{name}") for name, c in stats(value, p99).items()]


def _within(df: DataFrame, size: int) -> bool:
    """Whether Catalyst's estimate of df is at most `size` bytes; False where there is none."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString()) <= size
    except AttributeError:  # Spark Connect
        return False


def stats_by(df: DataFrame, keys: list[str], measures: dict[str, Column], p99: bool = True, others: list[Column] = (), small: int = SMALL) -> DataFrame:
    """keys, the aggregates `others`, and stats() of each measure with its prefix, for groups of any size.

    stats() holds the different values of a group in one task, so it is used on at most `small` bytes. Above that no task
    holds a group: percentiles are found by bands, of all measures at once. Both are exact. Keys must not be null. No keys:
    one row, also of no rows.
    """
    if _within(df.select(*keys, *measures.values()), small):
        return df.groupBy(*keys).agg(*others, *(c for prefix, m in measures.items() for c in stat_columns(m, prefix, p99)))
    df = df.withColumns({f"_m{k}": m.cast("double") for k, m in enumerate(measures.values())})
    simple = [c.alias(f"{prefix}{name}") for k, prefix in enumerate(measures) for name, c in (("count", F.count(f"_m{k}")), ("min", F.min(f"_m{k}")), ("max", F.max(f"_m{k}")), ("mean", F.avg(f"_m{k}")))]
    wanted = {f"p{round(q * 100)}": q for q in [0.5, 0.95, 0.99][: 3 if p99 else 2]}
    long = df.select(*keys, F.explode(F.array(*(F.struct(F.lit(k).alias("which"), F.col(f"_m{k}").alias("value")) for k in range(len(measures))))).alias("_x"))
    found = exact_percentiles(long.select(*keys, F.col("_x.which").alias("_which"), F.col("_x.value").alias("_value")), [*keys, "_which"], "_value", wanted)
    wide = found.groupBy(*keys).agg(*(F.max(F.when(F.col("_which") == k, F.col(name))).alias(f"{prefix}{name}") for k, prefix in enumerate(measures) for name in wanted))
    out = df.groupBy(*keys).agg(*others, *simple)
    out = out.join(wide, keys, "left") if keys else out.crossJoin(wide)  # a row and a row
    rest = [c for c in out.columns if c not in keys and not any(c == f"{prefix}{name}" for prefix in measures for name in STATS)]
    return out.select(*keys, *rest, *(f"{prefix}{name}" for prefix in measures for name in STATS[: 4 + len(wanted)]))


def prepare(events: DataFrame) -> DataFrame:
    """Events with defaults applied: stage, ok, records, the file's kind and family, and the duration for one record."""
    x = lambda f: nonempty(F.col(f"extra.{f}"))
    count = F.col("extra.record_count")
    records = F.when(count.isNull() | (count == 0), 1).otherwise(count)
    kind = F.coalesce(x("source_type"), x("input_extension"), source_type(x("source_filename")))
    out = events.select(
        "ts", F.coalesce(nonempty(F.col("stage")), F.lit(UNKNOWN)).alias("stage"), (F.coalesce(nonempty(F.col("status")), F.lit("ok")) == "ok").alias("ok"), "duration_ms",
        nonempty(F.col("record_id")).alias("record_id"), records.alias("records"), x("source_filename").alias("source_filename"), x("parser_name").alias("parser_name"), kind.alias("source_type"),
        F.coalesce(x("raw_subfamily"), raw_subfamily(x("source_filename"), x("parser_name"), x("input_extension"), kind)).alias("raw_subfamily"), F.coalesce(x("name"), F.lit(UNKNOWN)).alias("name"),
    )
    return out.withColumn("per_record_ms", F.when(F.col("records") > 0, F.col("duration_ms") / F.col("records")).otherwise(F.col("duration_ms")))


def stage_latency(prepared: DataFrame) -> DataFrame:
    """Stats of the duration for one record, by stage."""
    return prepared.where(~F.col("stage").isin(*NOT_STAGES) & F.col("duration_ms").isNotNull()).transform(stats_by, ["stage"], {"": F.col("per_record_ms")})


def named_timing(prepared: DataFrame, stage: str) -> DataFrame:
    """Stats of the raw duration of task_timing or app_timing events, by name."""
    return prepared.where((F.col("stage") == stage) & F.col("duration_ms").isNotNull()).transform(stats_by, ["name"], {"": F.col("duration_ms")})


def _measures() -> dict[str, Column]:
    """The four durations of a record; null in events of other stages."""
    at = lambda *s: F.col("stage").isin(*s)
    return {"wall": F.when(at("record_wall"), F.col("duration_ms")), "parse": F.when(at("parse_dispatch"), F.col("per_record_ms")), "resolver": F.when(at("resolver_http"), F.col("duration_ms")), "db": F.when(at(*DB_STAGES), F.col("per_record_ms"))}


def per_record_metrics(prepared: DataFrame) -> DataFrame:
    """One row with the stats of wall, parse, resolver and db."""
    return stats_by(prepared, [], {f"{name}_": m for name, m in _measures().items()})


def _count_columns(exclude_stages: tuple[str, ...] = ()) -> list[Column]:
    seen = ~F.col("stage").isin(*exclude_stages) if exclude_stages else F.lit(True)
    return [
        F.count_distinct(F.when(seen, F.col("source_filename"))).alias("files_processed"), F.coalesce(F.sum(F.when(F.col("stage") == "ingest_enqueue", F.col("records"))), F.lit(0)).cast("long").alias("records_submitted"),
        F.count_distinct(F.when(seen, F.col("record_id"))).alias("records_processed"), F.count(F.when(~F.col("ok"), 1)).alias("failures"),
    ]


def counts(prepared: DataFrame, exclude_stages: tuple[str, ...] = ()) -> DataFrame:
    """Files and records seen, records submitted and failures; files and records of excluded stages aren't seen."""
    return prepared.agg(*_count_columns(exclude_stages))


def errors_by_stage(prepared: DataFrame) -> DataFrame:
    return prepared.where(~F.col("ok")).groupBy("stage").agg(F.count("*").alias("errors"))


def throughput(prepared: DataFrame, started_at: float | None = None, ended_at: float | None = None, mean_load: float | None = None) -> DataFrame:
    """Wall seconds, records a minute, and that times the mean load where it is above 1; null without a duration."""
    both = prepared.agg(*_count_columns(), F.min("ts").alias("first"), F.max("ts").alias("last"))
    start, end = (F.lit(v).cast("double") if v is not None else F.col(c) for v, c in ((started_at, "first"), (ended_at, "last")))
    wall = F.greatest(F.lit(0.0), end - start)
    records = F.when(F.col("records_processed") > 0, F.col("records_processed")).otherwise(F.col("records_submitted"))
    factor = F.greatest(F.lit(1.0), F.lit(mean_load).cast("double")) if mean_load is not None else F.lit(1.0)
    rate = F.when(wall > 0, records / wall * 60)
    return both.select(F.when(start.isNotNull() & end.isNotNull(), wall).alias("wall_clock_s"), rate.alias("overall_records_per_minute"), factor.alias("host_load_adjustment_factor"), (rate * factor).alias("load_adjusted_records_per_minute"))


def completion_status(prepared: DataFrame, expected_files: int | None = None) -> DataFrame:
    short = F.lit(False) if expected_files is None else (F.col("files_processed") < expected_files) | F.lit(expected_files == 0)
    return counts(prepared).select(F.when(short, "incomplete").otherwise("complete").alias("status"))


def breakdown(prepared: DataFrame, by: str, wall_s: Column | None = None) -> DataFrame:
    """By source_type, parser_name or raw_subfamily: files, records, stats of the four durations, and records a minute of wall_s.

    A null kind or parser counts as unknown; events of no raw family are in none. Only timed events that aren't task or app timings count.
    """
    timed = prepared.where(F.col("duration_ms").isNotNull() & ~F.col("stage").isin(*NOT_STAGES))
    key = F.col(by) if by == "raw_subfamily" else F.coalesce(by, F.lit(UNKNOWN))
    grouped = timed.withColumn("group", key).where("group is not null")
    seen = [F.count_distinct("source_filename").alias("file_count"), F.count_distinct("record_id").alias("record_count")]
    out = stats_by(grouped, ["group"], {f"{name}_": m for name, m in _measures().items()}, others=seen)
    if wall_s is None:
        return out
    return out.withColumn("throughput_records_per_minute", F.when((wall_s > 0) & (F.col("record_count") > 0), F.col("record_count") / wall_s * 60))


def slowest(groups: DataFrame, limit: int | None = 10) -> DataFrame:
    """Groups by their 95th percentile of wall time, the slowest first; null counts as 0, ties by name."""
    ordered = groups.orderBy(F.coalesce("wall_p95", F.lit(0.0)).desc(), "group")
    return ordered.limit(limit) if limit else ordered


def unpivot_stats(samples: DataFrame, metrics: tuple[str, ...] = SYSTEM_METRICS) -> DataFrame:
    """Stats without p99 of each metric column, one row a metric."""
    long = samples.unpivot([], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    return stats_by(long, ["metric"], {"": F.col("value")}, p99=False)


def load_factor(samples: DataFrame) -> DataFrame:
    return samples.agg(F.greatest(F.lit(1.0), F.avg("normalized_load_1m")).alias("factor"))


# Reports -------------------------------------------------------------------


def _nested(row: dict, prefix: str) -> dict:
    return {k: row[f"{prefix}{k}"] for k in STATS if f"{prefix}{k}" in row}


def summarize(events: DataFrame, started_at: float | None = None, ended_at: float | None = None, expected_files: int | None = None, samples: DataFrame | None = None) -> dict:
    """The summary of a run as nested dicts. What is collected is one row for each stage, timing name or group."""
    prepared = prepare(events)
    load = {r["metric"]: {k: r[k] for k in STATS if k != "p99"} for r in unpivot_stats(samples).collect()} if samples is not None else {}
    rate = throughput(prepared, started_at, ended_at, (load.get("normalized_load_1m") or {}).get("mean")).first().asDict()
    wall = rate.pop("wall_clock_s")
    record = per_record_metrics(prepared).first().asDict()
    groups = {}
    for by in ("source_type", "parser_name", "raw_subfamily"):
        groups[by] = {
            r["group"]: {"file_count": r["file_count"], "record_count": r["record_count"], **{f"{n}_ms": _nested(r.asDict(), f"{p}_") for p, n in (("wall", "wall_time"), ("parse", "parse_stage"), ("resolver", "resolver_stage"), ("db", "db_stage"))}, "throughput_records_per_minute": r["throughput_records_per_minute"]}
            for r in breakdown(prepared, by, F.lit(wall).cast("double")).collect()
        }
    by_name = lambda df, key: {r[key]: _nested(r.asDict(), "") for r in df.collect()}
    return {
        "counts": {"files_selected": int(expected_files or 0), **counts(prepared).first().asDict()}, "throughput": rate, "latency_ms": by_name(stage_latency(prepared), "stage"),
        "task_timing_ms": by_name(named_timing(prepared, "task_timing"), "name"), "app_timing_ms": by_name(named_timing(prepared, "app_timing"), "name"), "duration_s": {"wall_clock": wall},
        "per_record_metrics_ms": {n: _nested(record, f"{p}_") for p, n in (("wall", "wall_time"), ("parse", "parse_stage"), ("resolver", "resolver_stage"), ("db", "db_stage"))},
        "source_type_breakdown": groups["source_type"], "parser_breakdown": groups["parser_name"], "raw_subfamily_breakdown": groups["raw_subfamily"],
        "errors": {"by_stage": {r["stage"]: r["errors"] for r in errors_by_stage(prepared).collect()}}, "status": completion_status(prepared, expected_files).first()["status"], "system_load": {"summary": load},
    }


def to_json(summary: dict) -> str:
    return json.dumps(summary, indent=2, sort_keys=True)


def _number(value, digits: int = 2) -> str:
    return "n/a" if value is None else f"{value:.{digits}f}"


def size_text(value: float | None) -> str:
    """Bytes as B, KiB, MiB, GiB or TiB."""
    if value is None:
        return "n/a"
    units = ("B", "KiB", "MiB", "GiB", "TiB")
    k = 0
    while value >= 1024 and k < len(units) - 1:
        value, k = value / 1024, k + 1
    return f"{value:.2f} {units[k]}"


def to_markdown(summary: dict) -> str:
    """The report: counts, time for a record, stages, the slowest kinds of file, parsers, raw families, system load."""
    rank = lambda groups, key: sorted(groups.items(), key=key)
    slow = lambda kv: (-(kv[1]["wall_time_ms"]["p95"] or 0), kv[0])

    def table(title: str, head: list[str], rows: list[list[str]]) -> list[str]:
        return [f"## {title}", "", "| " + " | ".join(head) + " |", "|" + " --- |" * len(head), *("| " + " | ".join(r) + " |" for r in rows), ""]

    group_head = ["group", "files", "records", "wall p50", "wall p95", "parse p95", "resolver p95", "db p95", "records/min"]
    group_row = lambda kv: [kv[0], str(kv[1]["file_count"]), str(kv[1]["record_count"]), _number(kv[1]["wall_time_ms"]["p50"]), *(_number(kv[1][f"{m}_ms"]["p95"]) for m in ("wall_time", "parse_stage", "resolver_stage", "db_stage")), _number(kv[1]["throughput_records_per_minute"])]
    stat_head, stat_row = ["name", "count", "p50", "p95", "p99", "mean"], lambda kv: [kv[0], str(kv[1]["count"]), *(_number(kv[1][k]) for k in ("p50", "p95", "p99", "mean"))]
    out = [f"# Run report ({summary['status']})", "", *(f"- {k}: {v}" for k, v in summary["counts"].items()), f"- wall seconds: {_number(summary['duration_s']['wall_clock'])}", *(f"- {k}: {_number(v)}" for k, v in summary["throughput"].items()), ""]
    out += table("Time for a record (ms)", stat_head, [stat_row(kv) for kv in summary["per_record_metrics_ms"].items()])
    out += table("Stage latency (ms a record)", stat_head, [stat_row(kv) for kv in sorted(summary["latency_ms"].items())])
    out += table("Slowest kinds of file", group_head, [group_row(kv) for kv in rank(summary["source_type_breakdown"], slow)[:10]])
    out += table("Kinds of file", group_head, [group_row(kv) for kv in sorted(summary["source_type_breakdown"].items())])
    out += table("Parsers", group_head, [group_row(kv) for kv in sorted(summary["parser_breakdown"].items())])
    out += table("Raw families", group_head, [group_row(kv) for kv in rank(summary["raw_subfamily_breakdown"], slow)])
    show = lambda m, v: size_text(v) if m.endswith("_bytes") else _number(v)
    out += table("System load", ["metric", "mean", "p95", "max"], [[m, *(show(m, v[k]) for k in ("mean", "p95", "max"))] for m, v in sorted(summary["system_load"]["summary"].items())])
    return "\n".join(out)


CSV_COLUMNS = ("source_type", "file_count", "record_count", "wall_p50_ms", "wall_p95_ms", "parse_p95_ms", "resolver_p95_ms", "db_p95_ms", "throughput_records_per_minute")


def to_csv(summary: dict) -> str:
    """Kinds of file, the slowest first; what is missing is empty."""
    sink = io.StringIO()
    out = csv.writer(sink, lineterminator="\n")
    out.writerow(CSV_COLUMNS)
    for name, g in sorted(summary["source_type_breakdown"].items(), key=lambda kv: (-(kv[1]["wall_time_ms"]["p95"] or 0), kv[0])):
        row = [name, g["file_count"], g["record_count"], g["wall_time_ms"]["p50"], *(g[f"{m}_ms"]["p95"] for m in ("wall_time", "parse_stage", "resolver_stage", "db_stage")), g["throughput_records_per_minute"]]
        out.writerow(["" if v is None else v for v in row])
    return sink.getvalue()


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
