"""Telemetry that a run writes about itself: timed stages as JSON lines, host samples, settings of a benchmark."""

from __future__ import annotations

import contextlib
import fcntl
import functools
import json
import os
import platform
import threading
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import file_extension, raw_subfamily, source_type
from ..schemas import EVENT


class EventLog:
    """Appends events to a JSON-lines file, one writer at a time; what cannot be written is dropped without a word."""

    def __init__(self, path: str | None, run_id: str | None = None, context_id: str | None = None) -> None:
        self.path, self.run_id, self.context_id, self._lock = path, run_id or uuid.uuid4().hex, context_id, threading.Lock()

    def emit(self, stage: str, duration_ms: float | None = None, status: str = "ok", record_id: str | None = None, **extra) -> None:
        if not self.path:
            return
        event = {"ts": time.time(), "stage": stage, "run_id": self.run_id, "context_id": self.context_id, "record_id": record_id, "duration_ms": duration_ms, "status": status, "extra": {k: v for k, v in extra.items() if v is not None}}
        with contextlib.suppress(OSError, ValueError), self._lock, open(self.path, "a", encoding="utf-8") as file:
            fcntl.flock(file, fcntl.LOCK_EX)
            file.write(json.dumps(event, sort_keys=True) + "\n")

    @contextlib.contextmanager
    def timed(self, stage: str, **told) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        except Exception as error:
            self.emit(stage, (time.perf_counter() - began) * 1000, "error", error=str(error), error_type=type(error).__name__, **told)
            raise
        self.emit(stage, (time.perf_counter() - began) * 1000, **told)

    def profiled(self, stage: str, **told) -> Callable:
        def wrap(function: Callable) -> Callable:
            @functools.wraps(function)
            def run(*args, **kwargs):
                with self.timed(stage, **told):
                    return function(*args, **kwargs)

            return run

        return wrap


def system_sample() -> dict:
    """Load and memory of this host; what it does not tell is null."""
    cpus = os.cpu_count()
    sample: dict = {"ts": time.time(), "platform": platform.system().lower(), "cpu_count": cpus, "memory_probe": "unsupported"}
    with contextlib.suppress(OSError):
        for minutes, load in zip((1, 5, 15), os.getloadavg()):
            sample[f"loadavg_{minutes}m"], sample[f"normalized_load_{minutes}m"] = load, load / (cpus or 1)
    with contextlib.suppress(OSError, KeyError), open("/proc/meminfo", encoding="ascii") as file:
        told = {line.split(":")[0]: float(line.split()[1]) * 1024 for line in file}
        total, free = told["MemTotal"], told["MemAvailable"]
        sample |= {"memory_probe": "proc_meminfo", "memory_total_bytes": total, "memory_available_bytes": free, "memory_used_bytes": total - free, "memory_available_ratio": free / total, "memory_used_ratio": 1 - free / total}
    return sample


@contextlib.contextmanager
def sampling(interval_s: float = 1.0) -> Iterator[list[dict]]:
    """A list that fills with samples, one each interval (0.1 s at least), until the block ends."""
    samples, stop = [system_sample()], threading.Event()

    def run() -> None:
        while not stop.wait(max(0.1, interval_s)):
            samples.append(system_sample())

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield samples
    finally:
        stop.set()
        thread.join()


@contextlib.contextmanager
def environment(**settings: str | None) -> Iterator[None]:
    """Environment variables for a block, and their old values after it."""
    before = {k: os.environ.get(k) for k in settings}
    try:
        for k, v in settings.items():
            os.environ.pop(k, None) if v is None else os.environ.__setitem__(k, v)
        yield
    finally:
        for k, v in before.items():
            os.environ.pop(k, None) if v is None else os.environ.__setitem__(k, v)


# What an ingest tells about itself -----------------------------------------


def _events(rows: DataFrame, stage: str, ts: float, duration_ms: Column | None = None, n: Column | None = None, record_id: Column | None = None, error: Column | None = None, run_id: str | None = None, context_id: str | None = None) -> DataFrame:
    """An event for each row (source_filename, and parser_name and source_bibcode if there are such columns)."""
    name = F.col("source_filename")
    parser = F.col("parser_name") if "parser_name" in rows.columns else F.lit(None).cast("string")
    told = {"source_filename": name, "parser_name": parser, "input_extension": file_extension(name), "source_type": source_type(name), "raw_subfamily": raw_subfamily(name, parser), "record_count": n, "error": error}
    if "source_bibcode" in rows.columns:
        told["source_bibcode"] = F.col("source_bibcode")
    extra = F.struct(*((F.lit(None) if told.get(f.name) is None else told[f.name]).cast(f.dataType).alias(f.name) for f in EVENT["extra"].dataType))
    values = {"ts": F.lit(ts), "stage": F.lit(stage), "run_id": F.lit(run_id), "context_id": F.lit(context_id), "record_id": record_id, "duration_ms": duration_ms, "status": F.lit("ok" if error is None else "error"), "extra": extra}
    return rows.select(*((F.lit(None) if values[f.name] is None else values[f.name]).cast(f.dataType).alias(f.name) for f in EVENT))


def ingest_events(parsed: DataFrame, blocks: DataFrame, items: DataFrame, ms: dict[str, float], ts: float, run_id: str | None = None, context_id: str | None = None) -> DataFrame:
    """The events of one ingest, in the shape of the log.

    parsed: source_filename, parser_name, error, parse_ms (of the whole file, on each of its rows); blocks: source_filename,
    source_bibcode, parser_name, n (references); items: source_filename, source_bibcode, id. Parsing is timed file by file.
    Lookup, load, resolve and update run for all at once: ms has what they took, of which each file or reference gets its even share.
    """
    made = {"ts": ts, "run_id": run_id, "context_id": context_id}
    files = parsed.groupBy("source_filename", "parser_name").agg(F.max("parse_ms").alias("parse_ms"), F.count(F.when(F.col("error").isNull(), 1)).alias("n"))
    sums = files.agg(F.count("*").alias("n_files")).crossJoin(blocks.agg(F.sum("n").alias("n_all")))  # one row by one row
    with_sums = lambda df: df.join(F.broadcast(sums))  # noqa: E731  one row
    share = lambda *stages: F.lit(float(sum(ms[s] for s in stages))) / F.greatest("n_all", F.lit(1))
    files, blocks, items = with_sums(files), with_sums(blocks), with_sums(items)
    n = F.col("n")
    parts = [
        _events(files, "parser_lookup", duration_ms=F.lit(float(ms["lookup"])) / F.col("n_files"), n=F.lit(1), **made),
        _events(files, "parse_dispatch", duration_ms=F.col("parse_ms"), n=n, **made),
        _events(files, "file_wall", duration_ms=F.lit(float(ms["lookup"])) / F.col("n_files") + F.col("parse_ms") + n * share("load", "resolve", "update"), n=n, **made),
        _events(parsed.where("error is not null"), "record_error", error=F.col("error"), **made),
        _events(blocks, "pre_resolved_db", duration_ms=n * share("load"), n=n, **made),
        _events(blocks, "ingest_enqueue", n=n, **made),
        _events(blocks, "queue_references", duration_ms=n * share("resolve", "update"), n=n, **made),
        _events(items, "record_wall", duration_ms=share("resolve", "update"), n=F.lit(1), record_id=F.col("id"), **made),
        _events(items, "resolver_http", duration_ms=share("resolve"), n=F.lit(1), record_id=F.col("id"), **made),
        _events(items, "post_resolved_db", duration_ms=share("update"), n=F.lit(1), record_id=F.col("id"), **made),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def write_events(events: DataFrame, folder: str) -> None:
    """Adds events to a log that is a folder of JSON lines."""
    events.write.mode("append").json(folder)
