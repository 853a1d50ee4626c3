"""Token ids in binary files, packed by a static range asymmetric numeral system.

A file is a row of segments, each a few megabytes of text in ascending order of documents:

    header   magic, part, seq, table and body lengths, documents, blocks, tokens, CRC-32 of the rest, CRC-32 of the header
    table    the segment's frequency table, which all its blocks share (ids and counts that sum to 2**20, deflated)
    docs     id and token count of each document (deflated Arrow)
    index    for each block: lanes, tokens, words, CRC-32 - the checkpoints; every block decodes by itself
    blocks   for each: the final state of each lane (64 bits), then the renormalisation words (32 bits)
    newline  which Spark's text sink writes

Within a block token t of n goes to lane t % lanes at step t // lanes; all blocks have STEPS steps, so encoding and
decoding advance all lanes of all blocks of a segment together, one numpy operation a step.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import WordEncoder, in_chunks, spread, vocabulary
from .common import frugal, read_table, stored, tokenizer_path, work_path
from .simhash import _arrow_type

MAGIC = b"RANSTOK1"
HEADER = "<8sIIIQIIQI"
HEADER_SIZE = struct.calcsize(HEADER)
BITS = 20
STEPS = 512
BLOCK = 1 << 16
END_ID = 2


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids and their frequencies, each 1 at least, which sum to 2**BITS."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    freq = np.maximum(1, counts * (1 << BITS) // counts.sum())
    left = (1 << BITS) - int(freq.sum())
    if left >= 0:
        freq[np.argmax(freq)] += left
    for i in np.argsort(-freq, kind="stable"):  # else what is over goes off the largest
        if left >= 0:
            break
        off = min(-left, int(freq[i]) - 1)
        freq[i] -= off
        left += off
    return symbols, freq


def _lanes(counts: np.ndarray) -> np.ndarray:
    return np.maximum(1, -(-counts // STEPS))


def rans_encode(symbols: np.ndarray, freq: np.ndarray, stream: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The final states of all lanes, and each block's words. stream: ids of all blocks one after another, counts: of each block."""
    lanes = _lanes(counts)
    width = int(lanes.sum())
    code = np.zeros(int(symbols[-1]) + 1, np.int64)
    code[symbols] = np.arange(len(symbols))
    freq, first = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
    filler = int(np.argmax(freq))
    grid = np.full((STEPS, width), filler, np.int64)
    lane_start, block_start = np.cumsum(lanes) - lanes, np.cumsum(counts) - counts
    inner = np.arange(len(stream)) - np.repeat(block_start, counts)
    wide = np.repeat(lanes, counts)
    grid[inner // wide, np.repeat(lane_start, counts) + inner % wide] = code[stream]
    state = np.full(width, 1 << 32, np.uint64)
    words, sent = np.zeros((STEPS, width), np.uint32), np.zeros((STEPS, width), bool)
    shift, low = np.uint64(64 - BITS), np.uint64(32)
    for t in range(STEPS - 1, -1, -1):
        f, c = freq[grid[t]], first[grid[t]]
        over = (state >> shift) >= f
        sent[t] = over
        words[t] = state.astype(np.uint32)
        state = np.where(over, state >> low, state)
        whole = state // f
        state = (whole << np.uint64(BITS)) + (state - whole * f) + c
    return state, [words[:, a : a + n][sent[:, a : a + n]] for a, n in zip(lane_start.tolist(), lanes.tolist())]


def rans_decode(symbols: np.ndarray, freq: np.ndarray, state: np.ndarray, words: list[np.ndarray], counts: np.ndarray) -> np.ndarray:
    """The ids of all blocks one after another."""
    lanes = _lanes(counts)
    freq = freq.astype(np.uint64)
    first = np.cumsum(freq) - freq
    of_slot = np.repeat(np.arange(len(symbols), dtype=np.int32), freq.astype(np.int64))
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
    at = np.cumsum(sizes) - sizes
    lane_start = np.cumsum(lanes) - lanes
    block = np.repeat(np.arange(len(lanes)), lanes)
    grid = np.empty((STEPS, len(state)), np.int32)
    mask, bits, low = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
    for t in range(STEPS):
        slot = state & mask
        s = of_slot[slot]
        grid[t] = s
        state = freq[s] * (state >> bits) + slot - first[s]
        need = np.flatnonzero(state < np.uint64(1 << 32))
        owner = block[need]
        taken = np.bincount(owner, minlength=len(lanes))
        place = at[owner] + np.arange(len(need)) - np.repeat(np.cumsum(taken) - taken, taken)
        state[need] = state[need] << low | flat[place]
        at = at + taken
    inner = spread(np.zeros(len(counts), np.int64), counts)
    wide = np.repeat(lanes, counts)
    return symbols[grid[inner // wide, np.repeat(lane_start, counts) + inner % wide]]


def _blocks_of(lengths: np.ndarray) -> np.ndarray:
    """Tokens of each block: whole documents, BLOCK tokens at least but for the last."""
    ends = np.cumsum(lengths)
    cuts, start = [], 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = min(len(ends), int(np.searchsorted(ends, base + BLOCK)) + 1)
        cuts.append(int(ends[stop - 1] - base))
        start = stop
    return np.array(cuts, np.int64)


def pack_segment(ids: pa.Array, rows: list[np.ndarray], part: int, seq: int) -> bytes:
    """One segment without its newline."""
    lengths = np.array([len(r) for r in rows], np.int64)
    stream = np.concatenate(rows).astype(np.int64)
    counts = _blocks_of(lengths)
    symbols, freq = frequency_table(stream)
    state, words = rans_encode(symbols, freq, stream, counts)
    lanes = _lanes(counts)
    ends = np.cumsum(lanes)
    bodies = [state[e - n : e].astype("<u8").tobytes() + w.astype("<u4").tobytes() for e, n, w in zip(ends.tolist(), lanes.tolist(), words)]
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    sink = pa.BufferOutputStream()
    listed = pa.RecordBatch.from_arrays([ids, pa.array(lengths)], names=["id", "n"])
    with pa.ipc.new_stream(sink, listed.schema) as out:
        out.write_batch(listed)
    docs = zlib.compress(sink.getvalue().to_pybytes(), 1)
    index = b"".join(struct.pack("<IQII", n, c, len(w), zlib.crc32(b)) for n, c, w, b in zip(lanes.tolist(), counts.tolist(), words, bodies))
    body = struct.pack("<I", len(docs)) + docs + index + b"".join(bodies)
    rest = table + body
    head = struct.pack(HEADER, MAGIC, part, seq, len(table), len(body), len(rows), len(counts), len(stream), zlib.crc32(rest))
    return head + struct.pack("<I", zlib.crc32(head)) + rest


def read_header(data: bytes) -> tuple:
    """(part, seq, table bytes, body bytes, documents, blocks, tokens, crc) of the segment at the start of data."""
    head = data[: HEADER_SIZE]
    if zlib.crc32(head) != struct.unpack_from("<I", data, HEADER_SIZE)[0] or head[:8] != MAGIC:
        raise ValueError("not a segment header")
    return struct.unpack(HEADER, head)[1:]


def unpack_segment(data: bytes) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    """(id, n) of the documents, and the ids of each."""
    _, _, n_table, _, _, n_blocks, _, crc = read_header(data)
    rest = memoryview(data)[HEADER_SIZE + 4 :]
    if zlib.crc32(rest) != crc:
        raise ValueError("a segment's checksum differs")
    table = np.frombuffer(zlib.decompress(rest[:n_table]), "<u4").astype(np.int64)
    symbols, freq = np.cumsum(table[: len(table) // 2]), table[len(table) // 2 :]
    (n_docs,) = struct.unpack_from("<I", rest, n_table)
    at = n_table + 4 + n_docs
    listed = pa.ipc.open_stream(zlib.decompress(rest[n_table + 4 : at])).read_next_batch()
    entries = list(struct.iter_unpack("<IQII", rest[at : at + 20 * n_blocks]))
    at += 20 * n_blocks
    states, words = [], []
    for lanes, _, n_words, block_crc in entries:
        end = at + 8 * lanes + 4 * n_words
        if zlib.crc32(rest[at:end]) != block_crc:
            raise ValueError("a block's checksum differs")
        states.append(np.frombuffer(rest[at : at + 8 * lanes], "<u8"))
        words.append(np.frombuffer(rest[at + 8 * lanes : end], "<u4"))
        at = end
    stream = rans_decode(symbols, freq, np.concatenate(states), words, np.array([e[1] for e in entries], np.int64))
    return listed, np.split(stream, np.cumsum(listed.column("n").to_numpy())[:-1])


@lru_cache(2)
def library_encoder(path: str, remember: int = 600_000, special: bool = True) -> WordEncoder:
    """Encodes with the tokenizers library, each different word once in a worker's life: its ids are the same alone and within a text. special=False: special strings are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    whole, vocab = Tokenizer.from_file(path), vocabulary(path)
    words_only = Tokenizer(whole.model)
    words_only.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = [], []
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            ids = np.array(words_only.encode_batch_fast([[w.decode("utf-8", "surrogatepass") for w in part]], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int32)
            ends = np.searchsorted(np.cumsum(vocab.token_lengths[ids]), np.cumsum([len(w) for w in part]))  # tokens never cross words
            flat.append(ids)
            counts.append(np.diff(ends + 1, prepend=0))
        return np.concatenate(flat), np.concatenate(counts)

    return WordEncoder(vocab.special if special else {}, encode, remember)


def write_tokens(df: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Files of the ids of all texts in ascending order of id_col (nulls first; rows of one id by a hash of the text), end_id after each."""
    path = path or tokenizer_path()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("th"))
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(partitions, "id", "th").sortWithinPartitions("id", "th").select("id", "text")
    schema, id_type = pa.schema([("value", pa.binary())]), _arrow_type(rows, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = library_encoder(path), TaskContext.get().partitionId()
        for seq, (ids, texts) in enumerate(in_chunks(batches)):
            made = [np.append(m, np.int32(end_id)) for m in encoder.texts(texts)]
            yield pa.RecordBatch.from_arrays([pa.array([pack_segment(pa.array(ids, id_type), made, part, seq)], pa.binary())], schema=schema)

    ordered.mapInArrow(frugal(run), "value binary").select(F.col("value").cast("string")).write.text(out)


def token_index(spark: SparkSession, out: str) -> DataFrame:
    """(path, at, size, part, seq, n_docs, n_tokens, start): the segments, and the ids of all before each. Reads headers only."""
    files = spark.read.format("binaryFile").load(out).select("path", "length").where("length > 0")
    names = ["path", "at", "size", "part", "seq", "n_docs", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            rows = []
            for path, length in zip(*(c.to_pylist() for c in batch.columns)):
                system, name = FileSystem.from_uri(path)
                with system.open_input_file(name) as file:
                    at = 0
                    while at < length:
                        part, seq, n_table, n_body, n_docs, _, n_tokens, _ = read_header(file.read_at(HEADER_SIZE + 4, at))
                        size = HEADER_SIZE + 4 + n_table + n_body
                        rows.append((path, at, size, part, seq, n_docs, n_tokens))
                        at += size + 1
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string() if k == 0 else pa.int64()) for k in range(7)], names=names)

    found = stored(files.mapInArrow(run, "path string, at long, size long, part long, seq long, n_docs long, n_tokens long"), "index")
    before = Window.unboundedPreceding
    parts = found.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(before, -1)), F.lit(0)))
    inside = found.withColumn("skip", F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(before, -1)), F.lit(0)))
    return inside.join(parts.select("part", "base"), "part").select(*names, (F.col("base") + F.col("skip")).alias("start"))


def read_tokens(spark: SparkSession, out: str, id_col: str = "doc_id", id_type: str = "long", with_ids: bool = True) -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32, ids array<int>) of each document; ids is null unless with_ids. Segments decode in parallel."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    schema = pa.schema([("id", to_arrow_type(_parse_datatype_string(id_type))), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            for path, at, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, name = FileSystem.from_uri(path)
                with system.open_input_file(name) as file:
                    listed, rows = unpack_segment(file.read_at(size, at))
                n = listed.column("n").to_numpy()
                crc = [zlib.crc32(r.astype("<u4").tobytes()) for r in rows]
                ids = pa.array([r.astype(np.int32) for r in rows] if with_ids else [None] * len(rows), schema.field(4).type)
                yield pa.RecordBatch.from_arrays([listed.column("id"), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64()), ids], schema=schema)

    segments = token_index(spark, out).select("path", "at", "size", "start").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "at")
    return segments.mapInArrow(frugal(run), f"id {id_type}, start long, n_tokens long, ids_crc32 long, ids array<int>").withColumnRenamed("id", id_col)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_path(spark, "tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), out)
    return read_tokens(spark, out, with_ids=False).drop("ids")
