"""Embedding near-duplicates: all pairs of tiles by int8 products with rigorous error bounds.

A vector u of unit length is stored as s * q with int8 q; e is the length of u - s * q. For two of them,
|u.v - s_u s_v q_u.q_v| <= e_u + e_v + e_u e_v. Pairs whose bound is all at or above the threshold are links, those all
below are not, and only pairs that the threshold cuts are computed anew from the full vectors in double precision.

Equal vectors are collapsed first, with their number. Vectors are sorted by their nearest of a few pivots, which only
orders them, and cut into tiles with a centre and an angular radius: two tiles that the triangle inequality keeps apart
by more than the threshold's angle are never compared. A pair of tiles returns, for each vector, how many others it links
to, and a spanning forest of the links - never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .components import connected_components
from .simhash import local_roots

THRESHOLD = 0.9
PIVOTS = 64
TILE = 50_000  # vectors in a tile, about, of few dimensions
TILE_BYTES = 32 << 20  # of a tile's vectors in double precision, about
LEAST_TILES = 8
CENTRE_BYTES = 32 << 20  # of the centres of all tiles, which go to all tasks; with more, no pair of tiles is left out
BLOCK = 1024


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, scale, error) of unit vectors: int8 values, their scale, and the length of what they leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    return q.astype(np.int8), scale, np.linalg.norm(unit - q * scale[:, None], axis=1)


def unit_vectors(raw: np.ndarray) -> np.ndarray:
    """Rows at unit length in double precision; scaled first, so that no square overflows or vanishes."""
    scaled = raw.astype(np.float64) / np.abs(raw).max(axis=1, keepdims=True).astype(np.float64)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def link_tiles(a: np.ndarray, b: np.ndarray | None, many_a: np.ndarray, many_b: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(links, root, recomputed) of the rows of a, then b (None: a with itself): each row's linked others, counted with
    their multiplicities, the least row of its local component, and how many pairs needed full precision."""
    own = b is None
    b, many_b = (a, many_a) if own else (b, many_b)
    offset = 0 if own else len(a)
    n = len(a) + (0 if own else len(b))
    links, root, recomputed = np.zeros(n, np.int64), np.arange(n), 0
    (qa, sa, ea), (qb, sb, eb) = quantise(a), quantise(b)
    fa, fb = qa.astype(np.float32), qb.astype(np.float32)  # sums of int8 products stay below 2**24 up to 1040 dimensions
    exact = np.float32 if a.shape[1] <= 1024 else np.float64
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def join() -> None:
        nonlocal root, held, size
        if held:
            x, y = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            root = local_roots(n, np.concatenate([x, np.arange(n)]), np.concatenate([y, root]))
            held, size = [], 0

    for i in range(0, len(a), BLOCK):
        for j in range(i if own else 0, len(b), BLOCK):
            rows, cols = slice(i, min(i + BLOCK, len(a))), slice(j, min(j + BLOCK, len(b)))
            near = (fa[rows].astype(exact) @ fb[cols].astype(exact).T).astype(np.float64) * sa[rows, None] * sb[None, cols]
            bound = ea[rows, None] + eb[None, cols] + ea[rows, None] * eb[None, cols] + 1e-12
            hit = near - bound >= threshold
            open_x, open_y = np.nonzero((near + bound >= threshold) & ~hit)
            if own and i == j:
                keep = open_x < open_y
                open_x, open_y = open_x[keep], open_y[keep]
                hit = np.triu(hit, 1)
            for at in range(0, len(open_x), 1 << 16):
                x, y = open_x[at : at + (1 << 16)], open_y[at : at + (1 << 16)]
                recomputed += len(x)
                full = np.einsum("ij,ij->i", a[rows][x], b[cols][y])
                hit[x[full >= threshold], y[full >= threshold]] = True
            if hit.any():
                links[rows] += hit @ many_b[cols]
                links[offset:][cols] += many_a[rows] @ hit
                x, y = np.nonzero(hit)
                held.append((x + i, y + j + offset))
                size += len(x)
                if size > 1 << 21:
                    join()
    join()
    return links, root, recomputed


def _valid(v) -> F.Column:
    """Neither null nor zero, and all components finite numbers."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _tiles(threshold_rows: int, pivots: np.ndarray):
    """Each partition as one row, or as several of at most threshold_rows vectors."""
    names = ["tile", "n", "centre", "radius", "keys", "many", "vectors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def emit() -> pa.RecordBatch:
            nonlocal seq, held, size
            keys, many, vectors = (np.concatenate([h[k] for h in held]) for k in range(3))
            unit = unit_vectors(vectors)
            centre = unit.mean(axis=0)
            length = np.linalg.norm(centre)
            centre = centre / length if length > 1e-9 else unit[0]
            radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
            row = [part * 1_000_000 + seq, len(keys), centre.tobytes(), radius, keys.tobytes(), many.tobytes(), vectors.tobytes()]
            seq, held, size = seq + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, threshold_rows):
                p = batch.slice(at, threshold_rows)
                held.append((p.column(0).to_numpy(), p.column(1).to_numpy(), _matrix(p.column(2))))
                size += p.num_rows
                if size >= threshold_rows:
                    yield emit()
        if held:
            yield emit()

    return run


def _nearest_pivot(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                p = batch.slice(at, 4096)
                nearest = (unit_vectors(_matrix(p.column(2))) @ pivots.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*p.columns, pa.array(nearest.astype(np.int32))], names=["key", "many", "vector", "pivot"])

    return run


def _pairs(heads: list[tuple[int, np.ndarray | None, float]], threshold: float):
    """Each tile once for each pair that it is in; pairs that the triangle inequality rules out are left out, if there are centres."""
    order = {t: k for k, (t, _, _) in enumerate(heads)}
    known = all(h[1] is not None for h in heads)
    centres, radii = (np.array([h[1] for h in heads]), np.array([h[2] for h in heads])) if known else (None, None)
    limit = math.acos(threshold) + 1e-6
    names = ["a", "b", "side", "keys", "many", "vectors", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, n, keys, many, vectors in zip(*(batch.column(c).to_pylist() for c in ("tile", "n", "keys", "many", "vectors"))):
                me = order[tile]
                near = np.ones(len(heads), bool)
                if known:
                    near = np.arccos(np.clip(centres @ centres[me], -1, 1)) - radii - radii[me] <= limit
                    near[me] = True
                for other in np.flatnonzero(near).tolist():
                    a, b = min(me, other), max(me, other)
                    yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([b]), pa.array([int(me != a)]), pa.array([keys]), pa.array([many]), pa.array([vectors]), pa.array([n])], names=names)

    return run


def _compare(threshold: float):
    """Rows sorted by (a, b, side) -> (key, links, root): for each vector of a pair of tiles that links to another there."""
    schema = pa.schema([("key", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def load(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(row["keys"], np.int64), np.frombuffer(row["many"], np.int64), unit_vectors(np.frombuffer(row["vectors"], np.float64).reshape(row["n"], -1))

    def emit(first: dict, second: dict | None) -> pa.RecordBatch:
        keys, many, unit = load(first)
        if second is None:
            links, root, _ = link_tiles(unit, None, many, None, threshold)
        else:
            more, many_b, unit_b = load(second)
            links, root, _ = link_tiles(unit, unit_b, many, many_b, threshold)
            keys = np.concatenate([keys, more])
        hit = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(keys[hit]), pa.array(links[hit]), pa.array(keys[root[hit]])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if row["a"] == row["b"]:
                    yield emit(row, None)
                elif row["side"] == 0:
                    held = row
                else:
                    yield emit(held, row)
                    held = None

    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row: its links of cosine >= threshold (above 0), the smallest id
    reachable over links, itself included, and whether that is its own.

    Null and zero vectors, and those with null or non-finite components, link with nothing. Equal vectors link with each
    other. Vectors of different lengths never link. Rows with equal ids are different vectors; null ids are never a
    component_id unless a component has no other, and are not kept.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(_valid(F.col("v")), F.col("v")))
    different = stored(rows.where("v is not null").groupBy("v").agg(F.count("*").alias("many"), F.min("id").alias("low")).withColumn("key", F.monotonically_increasing_id()), "vectors")
    edges = counts = None
    for size in sorted(r["d"] for r in different.select(F.size("v").alias("d")).distinct().collect()):  # as many as there are dimensions
        found = stored(_linked(different.where(F.size("v") == size), threshold, tile), "links")
        edges = found if edges is None else edges.unionByName(found)
    if edges is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    counts = edges.groupBy(F.col("key").alias("of")).agg(F.sum("links").alias("links"))
    roots = connected_components(edges, "key", "root").select(F.col("node"), F.col("root").alias("top"))
    classed = different.join(counts, F.col("key") == F.col("of"), "left").join(roots, F.col("key") == F.col("node"), "left")
    classed = stored(classed.select("v", "low", "many", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("top", "key").alias("top")), "classes")
    names = classed.groupBy("top").agg(F.min("low").alias("component"))
    told = classed.join(names, "top").select(F.col("v").alias("w"), (F.col("links") + F.col("many") - 1).alias("n_links"), "component")
    out = rows.join(told, F.col("v") == F.col("w"), "left")
    component = F.when(F.col("w").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _linked(different: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(key, links, root) of the different vectors of one dimension."""
    n = different.count()
    pivots = unit_vectors(np.array([r["v"] for r in different.orderBy(F.xxhash64("v")).limit(PIVOTS).collect()]))
    wide = 8 * pivots.shape[1]
    tile = max(1, min(tile, TILE_BYTES // wide))
    tiles = max(LEAST_TILES, -(-n // tile))
    placed = different.select("key", "many", "v").mapInArrow(_nearest_pivot(pivots), "key long, many long, vector array<double>, pivot int")
    dealt = placed.repartitionByRange(tiles, "pivot", "key").select("key", "many", "vector")
    made = stored(dealt.mapInArrow(_tiles(-(-n // tiles) + 1, pivots), "tile long, n long, centre binary, radius double, keys binary, many binary, vectors binary"), "tiles")
    told = made.select("tile", "radius", *(["centre"] if made.count() * wide <= CENTRE_BYTES else [])).orderBy("tile").collect()
    heads = [(r["tile"], np.frombuffer(r["centre"]) if "centre" in r else None, r["radius"]) for r in told]
    pairs = made.mapInArrow(_pairs(heads, threshold), "a long, b long, side long, keys binary, many binary, vectors binary, n long")
    return pairs.repartition(len(heads) * (len(heads) + 1) // 2 if len(heads) <= 64 else 4 * len(heads), "a", "b").sortWithinPartitions("a", "b", "side").mapInArrow(_compare(threshold), "key long, links long, root long")


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
r AS (SELECT DISTINCT x, x AS y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS low FROM r GROUP BY x), n AS (SELECT x, count(*) AS many FROM l GROUP BY x)
SELECT vec_id, coalesce(many, 0) AS n_links, coalesce(low, vec_id) AS component_id, vec_id = coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id
"""


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
