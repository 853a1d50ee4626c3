"""What the operators of this subpackage share: table reading, shared storage, Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

END_OF_TEXT = "<|endoftext|>"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where it is unset and all is one process (tests), one of our own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        current = context._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = current.get() if current.isDefined() else f"file://{tempfile.mkdtemp(prefix='refloom-')}"
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and cut its lineage; a lost executor loses nothing of it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def work_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def release_memory() -> None:
    """Give back what the allocators keep: Python workers live on from stage to stage, and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


#: How to forget what a worker remembers from task to task.
REMEMBERED: list[Callable[[], None]] = []


def forget() -> None:
    for drop in REMEMBERED:
        drop()


def frugal(run: Callable, remembers: bool = False) -> Callable:
    """For mapInArrow: run, and its memory given back when a task ends; what other operators remember goes first, unless run is to find it."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not remembers:
            forget()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def over_rows(make: Callable[[dict[str, list]], dict[str, object]], schema: pa.Schema, rows: int = 256) -> Callable:
    """For mapInArrow: make gets the columns of at most `rows` rows as lists and returns the columns of the result.
    Small slices bound what Python holds at a time, however long the texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = make({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, most: int | None = None) -> Iterator[pa.Table]:
    """Tables that each hold whole groups of equal keys, from batches that are sorted by key. A group of over `most` rows comes in parts, in tables one after another."""
    import pyarrow.compute as pc

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[-1]
        first_of_last = pc.index(keys, last).as_py()
        if held and held[-1].column(key)[-1] == last:  # one group all the way
            held.append(batch)
            if most and sum(b.num_rows for b in held) > most:
                yield pa.Table.from_batches(held)
                held = []
            continue
        done = pa.Table.from_batches([*held, batch.slice(0, first_of_last)])
        if done.num_rows:
            yield done
        held = [batch.slice(first_of_last)]
    if held:
        yield pa.Table.from_batches(held)


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts lineage as checkpoint() does, in fewer bytes."""
    spark, schema = df.sparkSession, df.schema
    path = work_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)
