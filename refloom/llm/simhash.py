"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a product of perfect codes on 64 bits: two binary Golay(23, 12) codes (radius 3), one
Hamming(15, 11) code (radius 1) and three uncoded bits, so every fingerprint is within 7 bits of its one nearest
anchor. Two fingerprints that differ in t bits have a midpoint within ceil(t / 2) bits of either; each fingerprint is
replicated to the nearest anchors of all points in that ball, which are the anchors within covering radius plus
ceil(t / 2) that can matter. So every linked pair meets at an anchor: the search is exact, not a sample.

Equal fingerprints are collapsed first. An anchor with more than `hot` different fingerprints is dealt out anew by
the midpoints themselves, at most 65 fingerprints each for t = 2, so no task ever holds a hot anchor. Per anchor only
a spanning forest of the links is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, frugal, over_rows, read_table, sorted_groups
from .components import connected_components

SEED = 42
GOLAY = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and exactly \x20 \x09-\x0D


def fingerprint(text: str | None, width: int = 3, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text; see simhash()."""
    words = _words(text)
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n < width:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
        starts = [0, *(e + 1 for e in ends[:-1])]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :])]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = SEED) -> DataFrame:
    """(id_col, fp): fp is the signed long with the 64 bits of the fingerprint.

    A-Z are lower-cased, words are runs of other than ASCII white space, shingles are `width` words joined by a space,
    each counted as often as it occurs; fewer words make one shingle, no words (null, empty, blank) make 0.
    """
    kept = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("id", _arrow_type(kept, "id")), ("fp", pa.int64())])

    def make(cols: dict[str, list]) -> dict[str, object]:
        return {"id": cols["id"], "fp": np.array([fingerprint(t, width, seed) for t in cols["text"]], np.uint64).view(np.int64)}

    return kept.mapInArrow(frugal(over_rows(make, schema)), f"id {kept.schema['id'].dataType.simpleString()}, fp long").withColumnRenamed("id", id_col)


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _golay_errors() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of 23-bit words, as a table for each of their bytes, and the error of each syndrome."""

    def syndrome(word: int) -> int:
        for i in range(22, 10, -1):
            if word >> i & 1:
                word ^= GOLAY << (i - 11)
        return word

    byte = np.array([[syndrome(v << 8 * k) if v << 8 * k < 1 << 23 else 0 for v in range(256)] for k in range(3)], np.uint64)
    errors = np.zeros(1 << 11, np.uint64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            errors[syndrome(word)] = word
    return byte, errors


_TABLES: list[np.ndarray] = []


def anchor_of(x: np.ndarray) -> np.ndarray:
    """The nearest anchor of each 64-bit word."""
    if not _TABLES:
        byte, errors = _golay_errors()
        hamming = np.zeros(1 << 15, np.uint64)
        for i in range(15):
            hamming ^= np.where(np.arange(1 << 15, dtype=np.uint64) >> np.uint64(i) & np.uint64(1), np.uint64(i + 1), np.uint64(0))
        _TABLES.extend((byte, errors, np.where(hamming > 0, np.uint64(1) << (hamming - np.uint64(1)), np.uint64(0)).astype(np.uint64)))
    byte, errors, hamming_errors = _TABLES
    out = x.copy()
    for at in (0, 23):
        w = x >> np.uint64(at) & np.uint64((1 << 23) - 1)
        out ^= errors[byte[0][w & np.uint64(255)] ^ byte[1][w >> np.uint64(8) & np.uint64(255)] ^ byte[2][w >> np.uint64(16)]] << np.uint64(at)
    return out ^ hamming_errors[x >> np.uint64(46) & np.uint64((1 << 15) - 1)] << np.uint64(46)


def ball(radius: int) -> np.ndarray:
    """All 64-bit words of at most `radius` set bits."""
    return np.array([sum(1 << b for b in bits) for w in range(radius + 1) for bits in combinations(range(64), w)], np.uint64)


def _replicate(key_of, radius: int):
    schema = pa.schema([("anchor", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = ball(radius)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = batch.slice(at, 4096).column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                keys = np.sort(key_of((x[:, None] ^ flips[None, :]).ravel()).reshape(len(x), -1), axis=1)
                first = np.ones(keys.shape, bool)
                first[:, 1:] = keys[:, 1:] != keys[:, :-1]
                yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(np.broadcast_to(x[:, None], keys.shape)[first].view(np.int64))], schema=schema)

    return run


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 with edges a-b: the smallest node of each node's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (up := root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _forest(limit: int):
    """Links within each anchor, as edges to the smallest row of each local component."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    radius = (limit + 1) // 2

    def pairs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a large group: edges that connect what the links connect, by common midpoints; a chain for each midpoint is right as all at a midpoint of an even limit link."""
        flips = ball(radius)
        z = (x[:, None] ^ flips[None, :]).ravel()
        owner = np.repeat(np.arange(len(x)), len(flips))
        order = np.argsort(z, kind="stable")
        z, owner = z[order], owner[order]
        same = np.flatnonzero(z[1:] == z[:-1])
        a, b = owner[same], owner[same + 1]
        near = np.bitwise_count(x[a] ^ x[b]) <= limit
        return a[near], b[near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "anchor"):
            key = table.column("anchor").to_numpy()
            x = table.column("fp").to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            small = np.repeat((sizes > 1) & ((sizes <= 64) | (limit % 2 == 1)), sizes)
            of_group = np.repeat(np.arange(len(starts)), sizes)
            rows = np.flatnonzero(small)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            shift = 1
            while len(rows):
                rows = rows[rows + shift < len(key)]
                rows = rows[of_group[rows] == of_group[rows + shift]]
                near = rows[np.bitwise_count(x[rows] ^ x[rows + shift]) <= limit]
                found.append((near, near + shift))
                shift += 1
            if limit % 2 == 0:
                for g in np.flatnonzero(sizes > 64):
                    a, b = pairs(x[starts[g] : starts[g] + sizes[g]])
                    found.append((a + starts[g], b + starts[g]))
            if not found:
                continue
            root = local_roots(len(x), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
            joined = np.flatnonzero(root != np.arange(len(x)))
            if len(joined):
                yield pa.RecordBatch.from_arrays([pa.array(x[joined].view(np.int64)), pa.array(x[root[joined]].view(np.int64))], schema=schema)

    return run


def near_fingerprints(fps: DataFrame, limit: int = 2, hot: int = 16384) -> DataFrame:
    """(a, b): edges between the different fingerprints in column fp whose components are those of all links of at most `limit` (even: 0, 2, 4) bits."""
    radius = (limit + 1) // 2
    by_anchor = fps.select("fp").mapInArrow(frugal(_replicate(anchor_of, radius)), "anchor long, fp long")
    large = by_anchor.groupBy("anchor").count().where(F.col("count") > hot).select("anchor")
    spread = by_anchor.join(large, "anchor", "left_semi").select("fp").distinct().mapInArrow(_replicate(lambda z: z, radius), "anchor long, fp long")
    edges = None
    for rows in (by_anchor.join(large, "anchor", "left_anti"), spread):
        part = rows.repartition("anchor").sortWithinPartitions("anchor", "fp").mapInArrow(frugal(_forest(limit)), "a long, b long")
        edges = part if edges is None else edges.unionByName(part)
    return edges


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, limit: int = 2) -> DataFrame:
    """(id_col, fp, component_id): component_id is the smallest id reachable over links of at most `limit` differing bits.

    Null and empty texts have fingerprint 0 and link like any others. Repeated rows come back as often as they came;
    null ids take part and never are a component_id (null if a component has no other). Extra columns are ignored.
    """
    prints = checkpoint(simhash(df, id_col, text_col, width))
    nodes = prints.groupBy("fp").agg(F.min(id_col).alias("low"))
    roots = connected_components(near_fingerprints(nodes, limit))
    classed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    classed = checkpoint(classed)
    names = classed.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(classed.join(names, "root").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """df with one row of each near-duplicate group: that with the smallest id. Rows of one id and text count as one group member each; a null id stays."""
    groups = near_duplicates(df, id_col, **options)
    drop = groups.where(F.col(id_col) > F.col("component_id")).select(id_col)
    return df.join(drop.distinct(), id_col, "left_anti")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
