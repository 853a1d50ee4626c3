"""Near copies by the exact Jaccard similarity of word shingles: SimHash by anchor-point covering first, then prefixes; shingles as the judge.

Most near copies differ in at most LIMIT of 64 bits of their SimHash. The anchor-point covering of simhash.near_fingerprints()
finds all such pairs, and the shingles of what it brings together are compared. Links that lie beyond those bits are left to
prefixes, which start from the components that the fingerprints made and compare nothing inside one again.

Two sets of similarity s share one of the first n - ceil(s * n) + 1 of their n shingles in any order that is common to all
texts (prefix filter). So texts meet by these prefixes, whatever the size of the corpus and however the edits lie, and the
search is exact. The order puts shingles that a sample has often last, which only saves work: any order is right.

1. Texts with equal sets are collapsed to a node. Nodes that share a prefix shingle meet at the smallest node that has it:
   near copies share dozens of shingles, but few smallest nodes. Shingles that one node alone has end here. The smallest
   nodes of frequent shingles, which are at most FREQUENT, are found by aggregation and broadcast, so no task reads one.
2. A meeting place of over `most` nodes, or of over `heavy` shingles in all, is dealt out in blocks; a few of its nodes, chosen
   by hash, go to every block, which joins most crowds of near copies. In each place or block, nodes stay that have a partner allowed by size and by wide
   SimHash fingerprints; their shingles, made of the texts once, are sent there and compared. What leaves is a forest of
   the links, never their pairs.
3. Of places that were dealt out, nodes of different components meet again: those of the largest component and the others
   are dealt out in blocks so that each pair of blocks meets in a slot of its own.

At a similarity of 0.8 about 39 of 256 bits of two fingerprints differ, with a deviation of 6 (48 and 6 for sets of 4 and 5).
The filter lets 72 pass (96 where a set has less than SMALL shingles), so that it errs as seldom as a hash does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, over_rows, sorted_groups, stored
from .components import connected_components
from .simhash import SEED, _arrow_type, _words, near_fingerprints

WIDE = 4  # 64-bit words of the compared fingerprint, of which the first is the SimHash that anchors cover
LIMIT = 2  # bits of it that may differ
SMALL = 64
LOOSE, LOOSE_SMALL = 72, 96
SAMPLE = 8192  # texts from which frequent shingles are learned
OFTEN = 8  # texts of the sample that make a shingle a frequent one
FREQUENT = 200_000  # frequent shingles at most; the order of the others is by hash
HEAVY = 2_000_000  # shingles of all texts of a meeting place, above which it is dealt out: some 200 MB where they are compared
STANDING = 16  # nodes, about, that go to every block of a crowded place
TRIED = 64  # partners that are compared with a node at a time
WORDS = [f"w{k}" for k in range(WIDE)]
KINDS = ", ".join(f"{w} long" for w in WORDS)
PLACED = f"slot long, node long, comp long, side int, own int, n long, {KINDS}"


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _sums(h: np.ndarray, first_seed: int = 51) -> np.ndarray:
    """The fingerprint of 64 * WIDE bits of a set of hashes."""
    counts = np.zeros((WIDE, 64), np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        for k in range(WIDE):
            bits = np.unpackbits(_mixed(part, first_seed + k).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[k] += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(counts * 2 > len(h), axis=1, bitorder="little").view("<u8").ravel()


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """The sorted set of hashes of `width` words in a row; fewer words make one shingle."""
    words = np.array([xxhash.xxh64_intdigest(w, SEED) for w in _words(text)], np.uint64)
    n = max(1, min(width, len(words)))
    out = np.zeros(max(1, len(words) - n + 1), np.uint64)
    for k in range(n if len(words) else 0):
        out += _mixed(words[k : k + len(out)], 101 + k)
    return np.unique(out)


def _least(n: np.ndarray | int, similarity: float):
    """Shingles that a set of n shares at least with one that is similar."""
    return np.ceil(n * similarity - 1e-9).astype(int) if isinstance(n, np.ndarray) else int(np.ceil(n * similarity - 1e-9))


def prefix(h: np.ndarray, similarity: float, often: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set in the common order, (not frequent ones, by hash; frequent ones, from rare to common)."""
    first = len(h) - _least(len(h), similarity) + 1
    if not len(often):
        return h[:first], h[:0]
    at = np.minimum(np.searchsorted(often, h), len(often) - 1)
    known = often[at] == h
    rare = h[~known][:first]
    return rare, h[known][np.argsort(counts[at[known]], kind="stable")][: first - len(rare)]


def alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= similarity * (len(x) + len(y) - common) - 1e-9


def _frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ascending, and their counts) of shingles that many texts of a sample have."""
    step = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod("t1", F.lit(step)) == 0).dropDuplicates(["t1", "t2"]).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text, width).view(np.int64))], names=["h"])

    found = some.mapInArrow(frugal(run), "h long").groupBy("h").count().where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "h").limit(FREQUENT).toArrow()
    h, counts = found.column("h").to_numpy().view(np.uint64), found.column("count").to_numpy()
    order = np.argsort(h)
    return h[order], counts[order]


class _Rows:
    """Rows of some slots, sorted by slot, and which pairs of them sizes and fingerprints allow."""

    def __init__(self, table: pa.Table, similarity: float) -> None:
        self.key, self.node, self.comp, self.side, self.own, self.n = (table.column(c).to_numpy() for c in ("slot", "node", "comp", "side", "own", "n"))
        self.comp = self.comp.copy()
        self.wide = np.stack([table.column(w).to_numpy() for w in WORDS]).view(np.uint64)
        self.least = _least(self.n, similarity)
        self.loose = np.where(self.n < SMALL, LOOSE_SMALL, LOOSE)
        self.starts = np.flatnonzero(np.r_[True, self.key[1:] != self.key[:-1]])
        self.sizes = np.diff(np.r_[self.starts, len(self.key)])

    def near(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of rows, those of different components that size and wide fingerprints allow; of one side only where `own`."""
        may = (self.comp[x] != self.comp[y]) & ((self.own[x] > 0) | (self.side[x] != self.side[y])) & (self.least[x] <= self.n[y]) & (self.least[y] <= self.n[x])
        x, y = x[may], y[may]
        ok = np.bitwise_count(self.wide[:, x] ^ self.wide[:, y]).sum(axis=0) <= np.maximum(self.loose[x], self.loose[y])
        return x[ok], y[ok]


def _with_partners(similarity: float):
    """Of rows sorted by slot, those that have a partner in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "slot"):
            r = _Rows(table, similarity)
            has = np.zeros(len(r.key), bool)
            of_group = np.repeat(np.arange(len(r.starts)), r.sizes)
            rows, shift = np.flatnonzero(np.repeat((r.sizes > 1) & (r.sizes <= 64), r.sizes)), 1
            while len(rows):
                rows = rows[rows + shift < len(r.key)]
                rows = rows[of_group[rows] == of_group[rows + shift]]
                x, y = r.near(rows, rows + shift)
                has[x] = has[y] = True
                shift += 1
            for g in np.flatnonzero(r.sizes > 64):
                end = r.starts[g] + r.sizes[g]
                for one in range(r.starts[g], end - 1):
                    rest = np.arange(one + 1, end)
                    _, y = r.near(np.full(len(rest), one), rest)
                    has[y] = True
                    has[one] |= len(y) > 0
            if has.any():
                yield from table.filter(pa.array(has)).to_batches()

    return run


def _forest(width: int, similarity: float):
    """Rows sorted by slot, with their texts -> (a, b): a forest of the links in each slot."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "slot"):
            r, found = _Rows(table, similarity), []
            for start, size in zip(r.starts.tolist(), r.sizes.tolist()):
                if size == 1:
                    continue
                blobs = [shingles(t, width) for t in table.column("text").slice(start, size).to_pylist()]
                if size > 4:  # shingles by number, so that a set is marked once and others are looked up
                    _, at = np.unique(np.concatenate(blobs), return_inverse=True)
                    cuts = np.cumsum([len(h) for h in blobs])
                    mark, blobs = np.zeros(at.max() + 1, bool), np.split(at, cuts[:-1])
                for one in range(start, start + size - 1):
                    rest = np.arange(one + 1, start + size)
                    _, y = r.near(np.full(len(rest), one), rest)
                    if not len(y):
                        continue
                    if size > 4:
                        mark[blobs[one - start]] = True
                    for at_ in range(0, len(y), TRIED):
                        for k in y[at_ : at_ + TRIED]:
                            if r.comp[k] == r.comp[one]:
                                continue
                            common = int(mark[blobs[k - start]].sum()) if size > 4 else len(np.intersect1d(blobs[one - start], blobs[k - start], assume_unique=True))
                            if common >= similarity * (r.n[one] + r.n[k] - common) - 1e-9:
                                found.append((max(r.node[one], r.node[k]), min(r.node[one], r.node[k])))
                                mine = r.comp[start : start + size]
                                mine[mine == r.comp[k]] = r.comp[one]
                    if size > 4:
                        mark[blobs[one - start]] = False
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    return run


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))


def _prints(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """(id, t1, t2, d1, d2, n, tokens, often, w0, ...): of each text, hashes of its set, its size, prefix and wide fingerprint."""
    often, counts = _frequent(docs, width)
    schema = pa.schema([("id", _arrow_type(docs, "id")), *((c, pa.int64()) for c in ("t1", "t2", "d1", "d2", "n")), ("tokens", pa.list_(pa.int64())), ("often", pa.list_(pa.int64())), *((w, pa.int64()) for w in WORDS)])

    def make(cols: dict[str, list]) -> dict[str, object]:
        out: dict[str, list] = {f.name: [] for f in list(schema)[3:]}
        for text in cols["text"]:
            h = shingles(text, width)
            both = xxhash.xxh3_128_intdigest(h.tobytes())
            out["d1"].append((both >> 64) - (1 << 63))
            out["d2"].append((both & (1 << 64) - 1) - (1 << 63))
            out["n"].append(len(h))
            rare, frequent = prefix(h, similarity, often, counts)
            out["tokens"].append(rare.view(np.int64))
            out["often"].append(frequent.view(np.int64))
            for w, v in zip(WORDS, _sums(h).view(np.int64).tolist()):
                out[w].append(v)
        return {k: cols[k] for k in ("id", "t1", "t2")} | out

    return stored(docs.mapInArrow(frugal(over_rows(make, schema)), f"id {docs.schema['id'].dataType.simpleString()}, t1 long, t2 long, d1 long, d2 long, n long, tokens array<long>, often array<long>, {KINDS}"), "prints")


def _places(nodes: DataFrame) -> DataFrame:
    """(place, node, n): each node at the smallest node of each of its shingles that others have too."""
    shingle = Window.partitionBy("token")
    rare = nodes.select("node", "n", F.explode("tokens").alias("token")).select("node", "n", F.min("node").over(shingle).alias("place"), F.count("*").over(shingle).alias("c"))
    often = nodes.select("node", "n", F.explode("often").alias("token"))
    first = often.groupBy("token").agg(F.min("node").alias("place"), F.count("*").alias("c"))  # FREQUENT rows at most
    met = rare.unionByName(often.join(F.broadcast(first), "token").select("node", "n", "place", "c"))
    return stored(met.where("c > 1").select("place", "node", "n").distinct(), "places")


def _links(placed: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, similarity: float, known: DataFrame | None = None) -> DataFrame:
    """(a, b): a forest of the links in each slot of placed (slot, node, comp, side, own); known: (node, root) of nodes whose component is not comp but root."""
    told = nodes.select("node", "n", *WORDS)
    if known is not None:
        told = told.join(known, "node", "left")
        placed = placed.drop("comp")
    rows = placed.join(told, "node").withColumn("comp", F.col("comp") if known is None else F.coalesce("root", "node")).select(*(part.split()[0] for part in PLACED.split(", ")))
    rows = stored(rows.repartition("slot").sortWithinPartitions("slot", "node").mapInArrow(frugal(_with_partners(similarity)), PLACED), "near")
    asked = stored(rows.select("node").distinct().join(nodes.select("node", "at"), "node"), "asked")  # written first, so that its size decides the join
    here = docs["id"].eqNullSafe(asked["at.id"]) & (docs["t1"] == asked["at.t1"]) & (docs["t2"] == asked["at.t2"])
    texts = docs.join(asked, here).select("node", "text").dropDuplicates(["node"])
    sent = rows.join(texts, "node").repartition("slot").sortWithinPartitions("slot", "node")  # texts, which are smaller than their shingles
    return stored(sent.mapInArrow(frugal(_forest(width, similarity)), "a long, b long"), "links")


def _blocks(c: Column, weight: Column, most: int, heavy: int) -> Column:
    """In how many blocks c nodes with `weight` shingles are dealt out."""
    return F.greatest(F.ceil(c / F.lit(most)), F.ceil(weight / F.lit(heavy))).cast("long")


def _in_blocks(places: DataFrame, crowded: DataFrame) -> DataFrame:
    """(slot, node, comp, side, own): each place a slot; crowded ones (place, c, blocks) in blocks, with about STANDING of the nodes in each."""
    met = places.join(crowded, "place", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    stands = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 40)).cast("double") * F.col("c") < float(STANDING << 40)
    blk = F.when((F.col("blocks") > 1) & stands, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("blocks"))))
    dealt = met.select("place", "node", F.explode(blk).alias("blk"))
    return dealt.select(F.xxhash64("place", "blk").alias("slot"), "node", F.col("node").alias("comp"), F.lit(0).alias("side"), F.lit(1).alias("own"))


def _crowded(places: DataFrame, most: int, heavy: int) -> DataFrame:
    """(place, c, blocks) of the places that are dealt out in blocks."""
    sized = places.groupBy("place").agg(F.count("*").alias("c"), F.sum("n").alias("weight"))
    return stored(sized.select("place", "c", _blocks(F.col("c"), F.col("weight"), most, heavy).alias("blocks")).where("blocks > 1"), "crowded")


def fingerprint_places(nodes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(place, node, n): nodes (node, n, w0) that links of at most `limit` bits between fingerprints w0 bring together, by anchor-point covering."""
    fps = stored(nodes.select(F.col("w0").alias("fp")).distinct(), "fingerprints")
    roots = connected_components(near_fingerprints(fps, limit)).select(F.col("node").alias("fp"), "root")
    met = nodes.select("node", "n", F.col("w0").alias("fp")).join(roots, "fp", "left").select(F.coalesce("root", "fp").alias("place"), "node", "n")
    shared = met.groupBy("place").count().where("count > 1").select("place")
    return stored(met.join(shared, "place"), "near_prints")


def _in_pairs_of_blocks(rows: DataFrame, most: int, heavy: int) -> DataFrame:
    """Rows (place, node, n, comp) of places with several components, dealt to slots of at most 2 * `most` rows and 2 * `heavy` shingles or so in which every pair of different components meets."""
    kinds = rows.groupBy("place", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("weight"))
    groups = kinds.groupBy("place").agg(F.sum("c").alias("c"), F.sum("weight").alias("weight"), F.max(F.struct("c", "comp", "weight")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
    rest = _blocks(F.col("c") - F.col("top.c"), F.col("weight") - F.col("top.weight"), most, heavy)
    groups = groups.select("place", F.col("top.comp").alias("top"), _blocks(F.col("top.c"), F.col("top.weight"), most, heavy).alias("tops"), rest.alias("rest"))
    met = rows.join(groups, "place").withColumn("is_top", F.col("comp") == F.col("top"))
    met = met.withColumn("blk", F.pmod(F.xxhash64("node"), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("rest"))))
    slot = lambda kind, r, t, side, own: F.struct(F.xxhash64("place", F.lit(kind), r, t).alias("slot"), side.cast("int").alias("side"), own.cast("int").alias("own"))
    with_tops = lambda r, t, side: slot(1, r, t, F.lit(side), F.lit(0))
    zero, last, own = F.lit(0).cast("long"), F.col("rest") - 1, F.col("blk")
    places = F.when(F.col("is_top"), F.transform(F.sequence(zero, last), lambda r: with_tops(r, own, 1))).otherwise(
        F.concat(
            F.transform(F.sequence(zero, F.col("tops") - 1), lambda t: with_tops(own, t, 0)),
            F.transform(F.sequence(zero, last), lambda r: slot(2, F.least(r, own), F.greatest(r, own), (r < own), (r == own))),
        )
    )
    return met.select("node", "comp", F.explode(places).alias("p")).select("p.slot", "node", "comp", "p.side", "p.own")


def similar_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, most: int = 1024, heavy: int = HEAVY) -> DataFrame:
    """(id_col, component_id) by links of texts whose sets of `width` words in a row have a Jaccard similarity of at least `similarity`.

    Null, empty and blank texts are alike. Repeated rows come back as often as they came; null ids take part and are a
    component_id only of a component without others. Extra columns are ignored.
    """
    docs = _texts(df, id_col, text_col)
    prints = _prints(docs, width, similarity)
    nodes = prints.groupBy("d1", "d2").agg(F.min("id").alias("low"), F.max(F.struct("id", "t1", "t2")).alias("at"), *(F.first(c).alias(c) for c in ("n", "tokens", "often", *WORDS)))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    close = fingerprint_places(nodes)  # what a crowd of these leaves open, prefixes find
    links = _links(_in_blocks(close, _crowded(close, most, heavy)), nodes, docs, width, similarity)
    known = connected_components(links)
    places = _places(nodes)
    crowded = _crowded(places, most, heavy)
    links = links.unionByName(_links(_in_blocks(places, crowded), nodes, docs, width, similarity, known))
    if not crowded.isEmpty():
        near = connected_components(links).select(F.col("node").alias("of"), "root")
        left = places.join(crowded, "place", "left_semi").join(near, F.col("node") == F.col("of"), "left").select("place", "node", "n", F.coalesce("root", "node").alias("comp"))
        links = links.unionByName(_links(_in_pairs_of_blocks(stored(left, "left"), most, heavy), nodes, docs, width, similarity))

    roots = connected_components(links).select(F.col("node").alias("of"), F.col("root").alias("top"))
    classed = stored(nodes.join(roots, F.col("node") == F.col("of"), "left").select("d1", "d2", "low", F.coalesce("top", "node").alias("top")), "classes")
    names = classed.groupBy("top").agg(F.min("low").alias("component_id"))
    return prints.join(classed.join(names, "top").select("d1", "d2", "component_id"), ["d1", "d2"]).select(F.col("id").alias(id_col), "component_id")


def keep_first_similar(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """df with one row of each group of similar_documents(): that with the smallest id; null ids stay."""
    drop = similar_documents(df, id_col, **options).where(F.col(id_col) > F.col("component_id")).select(id_col)
    return df.join(stored(drop.distinct(), "drop"), id_col, "left_anti")
