"""Parsers over DataFrames: files or buffered blocks in, a row for each reference out. One pass, no shuffle."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PARSED_REFERENCE, REFERENCE_FIELDS
from .registry import parser_for

SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PARSED_REFERENCE) + ", error string"
ARROW = pa.schema([(f.name, pa.int32() if f.name in ("pos", "item_num") else pa.string()) for f in PARSED_REFERENCE] + [("error", pa.string())])
#: What goes out in one batch; a batch for each file would cost many times what parsing it does.
ROWS, BYTES = 1000, 4 << 20


def _rows(path: str, bibcode: str, raws: list[str], name: str, numbers: list[int] | None = None) -> Iterator[tuple]:
    if len(bibcode or "") != 19:
        yield (path, bibcode, None, None, None, *[None] * len(REFERENCE_FIELDS), "not a bibcode of 19 characters")
        return
    for k, (raw, found) in enumerate(zip(raws, parser_for(name).parse(raws))):
        number = int(numbers[k]) if numbers and k < len(numbers) and numbers[k] is not None else None
        if isinstance(found, Exception):
            yield (path, bibcode, k, number, raw, *[None] * len(REFERENCE_FIELDS), f"{type(found).__name__}: {found}")
        else:
            yield (path, bibcode, k, number, raw, *(found.get(f) for f in REFERENCE_FIELDS), None)


def _batched(files: Iterator[tuple[list[tuple], int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of files (rows, size of the file) in batches of at most ROWS rows, which hold several files up to BYTES."""
    held: list[tuple] = []
    size = 0

    def made() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(held), ROWS):
            columns = zip(*held[at : at + ROWS])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for rows, n in files:
        held += rows
        size += n
        if len(held) >= ROWS or size >= BYTES:
            yield from made()
            held, size = [], 0
    yield from made()


def parse_files(files: DataFrame, lookup: dict[str, str] | None = None) -> DataFrame:
    """References of files (path, content binary, parser_name), with the time that the whole file took; lookup gives the bibcode of a DOI or file code.

    What cannot be parsed comes out with its error, as do blocks without a sound bibcode: select on `error` for the
    accepted and the rejected. Unknown parsers, empty files and files without references give one row with the reason.
    """
    known = lookup or {}

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], int]]:
        for batch in batches:
            for path, content, name in zip(*(batch.column(c).to_pylist() for c in ("path", "content", "parser_name"))):
                began, parser, out = time.perf_counter(), parser_for(name or ""), []
                reason = None if parser else f"no parser {name}"
                if parser:
                    try:
                        text = bytes(content or b"").decode(parser.encoding, "replace" if parser.encoding == "UTF-8" else "ignore")
                        for bibcode, raws in parser.blocks(path, text, known.get):
                            out += _rows(path, bibcode, raws, name)
                        reason = None if out else "no references found"
                    except Exception as error:  # noqa: BLE001
                        reason = f"{type(error).__name__}: {error}"
                if reason:
                    out.append((path, None, None, None, None, *[None] * len(REFERENCE_FIELDS), reason))
                ms = (time.perf_counter() - began) * 1000
                yield [(*row, ms) for row in out], len(content or b"")

    schema = ARROW.append(pa.field("parse_ms", pa.float64()))
    return files.select("path", "content", "parser_name").mapInArrow(lambda batches: _batched(parsed(batches), schema), SCHEMA + ", parse_ms double")


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """References of buffered blocks (source_filename, parser_name, block_references), as reprocessing makes them: the raw text, else the text, is parsed again."""
    flat = blocks.select("source_filename", "parser_name", F.explode("block_references").alias("b")).select("source_filename", "parser_name", F.col("b.source_bibcode").alias("bib"), F.transform("b.references", lambda r: F.struct(r["item_num"].cast("int").alias("n"), F.coalesce(r["refraw"], r["refstr"]).alias("t"))).alias("refs"))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], int]]:
        for batch in batches:
            for path, name, bib, refs in zip(*(batch.column(c).to_pylist() for c in ("source_filename", "parser_name", "bib", "refs"))):
                raws = [r["t"] or "" for r in refs or []]
                yield list(_rows(path, bib, raws, name, [r["n"] for r in refs or []])) if parser_for(name or "") else [(path, bib, None, None, None, *[None] * len(REFERENCE_FIELDS), f"no parser {name}")], sum(map(len, raws))

    return flat.mapInArrow(lambda batches: _batched(parsed(batches), ARROW), SCHEMA)


def as_loaded(parsed: DataFrame, parser_name: str | None = None) -> DataFrame:
    """Accepted references by file and bibcode, in the shape that the store loads."""
    text = F.coalesce("refstr", "refplaintext", F.lit(""))
    good = parsed.where("error is null")
    return good.groupBy("source_filename", "source_bibcode").agg(F.sort_array(F.collect_list(F.struct("pos", "item_num", text.alias("refstr"), "refraw"))).alias("l")).select("source_filename", "source_bibcode", F.lit(parser_name).alias("parser_name"), F.transform("l", lambda x: F.struct(F.coalesce(x["item_num"], x["pos"] + 1).alias("item_num"), x["refstr"].alias("refstr"), x["refraw"].alias("refraw"))).alias("references"))
