"""Command line: diagnostics, resolve, stats and query over a store, and a benchmark of parsing with the mock resolver."""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import compare, history, resolve, routing, telemetry, timing
from .operators.store import Store
from .parse import parse_blocks, parse_files
from .parse.frames import as_loaded
from .sources import files as S

SHOWN = 5  # arguments of a list that are looked at


def positive(text: str) -> float:
    value = float(text)
    if value <= 0:
        raise argparse.ArgumentTypeError("must be above 0")
    return value


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="refloom", description=__doc__)
    top.add_argument("--store", default="store", help="folder of the tables")
    top.add_argument("--parsers", help="parser table as JSON lines")
    acts = top.add_subparsers(dest="action", required=True)
    act = acts.add_parser("diagnostics")
    act.add_argument("-b", "--bibcodes", nargs="*", default=[])
    act.add_argument("-s", "--sources", nargs="*", default=[])
    act = acts.add_parser("resolve")
    for flag, name, kind in (("-s", "source", str), ("-p", "path", str), ("-e", "extension", str), ("-c", "confidence", float), ("-b", "bibstem", str), ("-y", "year", str), ("-d", "days", int)):
        act.add_argument(flag, f"--{name}", type=kind, nargs="*" if name == "source" else None)
    act.add_argument("-f", "--failed", action="store_true")
    act.add_argument("--skip", help="file of directories that are done")
    act.add_argument("--rate", type=positive, default=1000.0, help="files a second between directories")
    act = acts.add_parser("stats")
    act.add_argument("-b", "--bibcode")
    act.add_argument("-s", "--source")
    act.add_argument("-c", "--count", action="store_true")
    act = acts.add_parser("query")
    act.add_argument("-b", "--bibcode", required=True)
    act.add_argument("-a", "--all", action="store_true", help="the best of each parser, not of all")
    act = acts.add_parser("benchmark")
    act.add_argument("path")
    act.add_argument("--patterns", nargs="*", default=["*.raw", "*.xml", "*.txt", "*.html", "*.tex", "*.refs", "*.pairs"])
    act.add_argument("--max-files", type=int)
    act.add_argument("--out", default="benchmark")
    act.add_argument("--interval", type=positive, default=1.0)
    return top


def ingest(spark: SparkSession, store: Store, files: DataFrame, parsers: DataFrame, resolver=resolve.mock_resolver, log: str | None = None) -> int:
    """Route, parse, stage and resolve files (path, content, modificationTime); returns the number of references.

    Each file is read and parsed once, each reference resolved once: what they give is written before it is used. log: a
    folder to which the events of all stages are added.
    """
    began, ms = time.perf_counter(), {}

    def took(stage: str) -> None:
        nonlocal began
        ms[stage], began = (time.perf_counter() - began) * 1000, time.perf_counter()

    paths = files.select(F.col("path").alias("source_filename"), F.col("modificationTime").alias("source_modified"))
    routed = store.written(routing.route(paths, parsers).where("parser_name is not null").select("source_filename", "source_modified", "parser_name"), "routed")
    took("lookup")
    names = routed.select(F.col("source_filename").alias("path"), "parser_name")
    parsed = store.written(parse_files(files.select("path", "content").join(names, "path")), "references").join(names.withColumnRenamed("path", "source_filename"), "source_filename")
    took("parse")
    loaded = as_loaded(parsed).drop("parser_name").join(routed, "source_filename")
    loaded = store.written(loaded.withColumns({"resolved_filename": F.concat("source_filename", F.lit(".result")), "date": F.current_timestamp()}), "blocks")
    staged = store.load(loaded, "initial")
    took("load")
    answers = store.written(resolve.answers(resolver(staged.select("id", F.col("reference_str").alias("refstr"), F.lit(None).cast("string").alias("refplaintext"), F.col("reference_raw").alias("refraw")))), "answers")
    took("resolve")
    store.resolve(answers)
    took("update")
    if log:
        blocks = loaded.select("source_filename", "source_bibcode", "parser_name", F.size("references").alias("n"))
        timing.write_events(timing.ingest_events(parsed, blocks, staged, ms, time.time()), log)
    return staged.count()


def reprocess(spark: SparkSession, store: Store, kind: str, resolver=resolve.mock_resolver, **options) -> int:
    """Parse and resolve again what a filter chooses, as new runs; returns the number of references."""
    t = {n: store.read(n) for n in ("resolved_reference", "processed_history", "reference_source")}
    batches = store.written(history.reprocess_batches(history.reprocess_rows(t["resolved_reference"], t["processed_history"], t["reference_source"], kind, **options)), "batches")
    loaded = as_loaded(parse_blocks(batches)).drop("parser_name").join(batches.select("source_filename", "parser_name", "source_modified").dropDuplicates(["source_filename"]), "source_filename")
    staged = store.load(loaded.withColumns({"resolved_filename": F.lit(None).cast("string"), "date": F.current_timestamp()}), "retry")
    refs = staged.select("id", F.col("reference_str").alias("refstr"), F.col("reference_raw").alias("refraw"))
    store.resolve(store.written(resolve.answers(resolver(refs)), "answers"))
    return staged.count()


def _benchmark(spark: SparkSession, args: argparse.Namespace) -> int:
    log = f"{args.out}-events"
    found = [r.path for r in S.candidates(spark, args.path, args.patterns, args.max_files).collect()]
    parsers = S.parser_table(spark, args.parsers)
    began = time.time()
    with timing.sampling(args.interval) as samples:
        n = ingest(spark, Store(spark, f"{args.out}-store"), S.binary_files(spark, found), parsers, log=log) if found else 0
    load = spark.createDataFrame([{k: float(v) if isinstance(v, float) else v for k, v in s.items()} for s in samples]) if samples else None
    have = [m for m in telemetry.SYSTEM_METRICS if load is not None and m in load.columns]
    summary = telemetry.summarize(S.events(spark, log), began, time.time(), len(found))
    if have:
        summary["system_load"]["summary"] = {r["metric"]: {k: r[k] for k in telemetry.STATS if k != "p99"} for r in telemetry.unpivot_stats(load, tuple(have)).collect()}
    summary["status"] = "complete" if n else "incomplete"
    for suffix, text in ((".json", telemetry.to_json(summary)), (".md", telemetry.to_markdown(summary)), (".csv", telemetry.to_csv(summary))):
        with open(args.out + suffix, "w", encoding="utf-8") as file:
            file.write(text)
    return 0 if summary["status"] == "complete" else 2


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("refloom").getOrCreate()
    store = Store(spark, args.store)
    t = {n: store.read(n) for n in ("reference_source", "processed_history", "resolved_reference", "compare_classic")}
    if args.action == "diagnostics":
        source, runs = t["reference_source"], t["processed_history"]
        for column, wanted in (("bibcode", args.bibcodes[:SHOWN]), ("source_filename", args.sources[:SHOWN])):
            if wanted:
                source, runs = source.where(F.col(column).isin(*wanted)), runs.where(F.col(column).isin(*wanted))
        found = history.diagnostics(source, runs, t["resolved_reference"])
        (found if args.bibcodes or args.sources else found.orderBy("bibcode").limit(10)).show(truncate=False)
    elif args.action == "resolve":
        kind = next((k for k, given in (("score", args.confidence is not None), ("bibstem", args.bibstem), ("year", args.year), ("failed", args.failed)) if given), None)
        if kind:
            print(reprocess(spark, store, kind, score_cutoff=args.confidence, match=args.bibstem or args.year, days=args.days))
        elif args.source or args.path:
            since = dt.datetime.now() - dt.timedelta(days=args.days) if args.days else None
            groups = [list(args.source)] if args.source else [r.paths for r in (lambda g: S.without_processed(g, spark, args.skip) if args.skip else g)(S.discover(spark, args.path, args.extension or "*", since)).orderBy("group").collect()]
            for k, paths in enumerate(groups):
                if k:
                    time.sleep(len(groups[k - 1]) / args.rate)
                print(ingest(spark, store, S.binary_files(spark, paths), S.parser_table(spark, args.parsers)))
        else:
            print("nothing to resolve", file=sys.stderr)
            return 1
    elif args.action == "stats":
        if args.count:
            history.table_counts(t).show(truncate=False)
        else:
            grid = compare.compare_grid(t["processed_history"], t["resolved_reference"], t["compare_classic"], bibcode=args.bibcode, filename=args.source)
            print(compare.draw_grid(r.asDict() for r in grid.orderBy("history_id", "item_num").toLocalIterator()))
            compare.grid_totals(grid).show()
    elif args.action == "query":
        ask = history.best_by_parser if args.all else history.best_by_priority
        ask(t["resolved_reference"], t["processed_history"], t["reference_source"], args.bibcode).orderBy("resolved_bibcode").show(truncate=False)
    elif args.action == "benchmark":
        os.makedirs(os.path.dirname(args.out) or ".", exist_ok=True)
        return _benchmark(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
