"""Repeated byte strings over a whole corpus, by suffix order and longest previous factors.

A suffix order of the whole corpus needs all suffixes in one place. Only strings of `length` bytes matter here, so the
order is truncated at that depth and dealt out by content: each window of `length` bytes goes to the bucket of its
minimizer, the least hash among its k-grams. Equal windows have equal minimizers and meet in one bucket; consecutive
windows with one minimizer travel as one segment. Three steps, each smaller than the one before:

1. Segments (about one for 85 bytes) carry two hashes, of the minimizer and of their bytes. Minimizers that occur once
   in the corpus end here, unless one is at two places of its segment. Those that repeat within a batch are known to
   repeat and are dealt out at random, all but one of each batch: a hot passage is pre-aggregated before the shuffle.
2. Segments with equal bytes repeat as a whole; one of them stands for the others.
3. What differs but shares a minimizer (the edges of repeated passages) is sorted byte for byte: in each bucket the
   suffix order at depth `length` by prefix doubling, and from it the longest previous factor of each window: its
   previous and next smaller positions in suffix order are where an earlier match is, if there is one. Buckets of more
   than `hot` segments are dealt out by whole windows instead, counted by native aggregation.

keep="first" removes later copies and keeps the first (by id, then position); keep="none" removes every copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, over_rows, read_table, sorted_groups, stored
from .simhash import _arrow_type

LENGTH = 200
GRAM = 32
CHUNK = 1 << 20  # bytes that are hashed or sorted at a time
RUN = 1024  # windows in a segment at most


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """For each position of data (uint8), the rank of its next `depth` bytes (8 at least) among all; equal strings have equal ranks, the end counts as zeros."""
    n = len(data)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key[: max(0, n - i)] |= data[i:].astype(np.uint64) << np.uint64(56 - 8 * i)

    def ranked(values: np.ndarray) -> np.ndarray:
        order = np.argsort(values)
        values = values[order]
        grown = np.ones(n, np.uint32)  # 0 is left for what lies past the end
        np.cumsum(values[1:] != values[:-1], dtype=np.uint32, out=grown[1:])
        grown[1:] += 1
        rank = np.empty(n, np.uint32)
        rank[order] = grown
        return rank

    rank, have = ranked(key), 8
    while have < depth:
        step = min(have, depth - have)
        key[:] = rank
        key <<= np.uint64(32)
        key[: max(0, n - step)] |= rank[step:]
        rank = ranked(key)
        have += step
    return rank


def previous_smaller(v: np.ndarray) -> np.ndarray:
    """For each place of v, the nearest place before it with a smaller value, -1 if there is none.

    All at once: what lies between a place and its candidate is larger, so a candidate that is larger too is replaced by its own.
    """
    found = np.arange(-1, len(v) - 1, dtype=np.int32)
    open_ = np.arange(1, len(v), dtype=np.int32)
    while len(open_):
        at = found[open_]
        open_ = open_[(at >= 0) & (v[at] > v[open_])]
        found[open_] = found[found[open_]]
    return found


def previous_factors(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each of the windows at the positions `starts` (ascending): a window before it that its longest previous factor,
    cut at `length` bytes, matches whole; -1 if that factor is shorter.

    In suffix order cut at that depth, equal windows by position, the longest previous factor is a match with the next
    smaller position on the left or on the right.
    """
    rank = suffix_ranks(data, length)[starts]
    order = np.argsort(rank, kind="stable").astype(np.int32)
    rank = rank[order]
    earlier = np.full(len(starts), -1, np.int32)
    for way in (1, -1):
        near = previous_smaller(order[::way])[::way]
        has = np.flatnonzero(near >= 0)
        near = near[has] if way == 1 else len(order) - 1 - near[has]
        whole = rank[has] == rank[near]
        earlier[order[has[whole]]] = order[near[whole]]
    return earlier


def repeated_windows(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows at the positions `starts` (ascending): whether an equal one starts earlier, and whether any other is equal."""
    earlier = previous_factors(data, starts, length)
    again = earlier >= 0
    any_ = again.copy()
    any_[earlier[again]] = True  # of equal windows each is the one before the next
    return again, any_


def _minimizers(data: np.ndarray, gram: int, windows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of `windows` (under 1024) k-grams: their least hash (54 bits), and its lowest and its highest place."""
    table = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64)
    h, base, have = table[data], np.uint64(0x9E3779B97F4A7C15 | 1), 1
    power = np.array([base])
    while have < gram:  # gram is a power of two
        h = h[:-have] * power + h[have:]
        power = power * power
        have *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(29)) & ~np.uint64(1023)
    place = np.arange(len(h), dtype=np.uint64) & np.uint64(1023)
    ends = [h | place, h | np.uint64(1023) - place]  # the least code of each is the hash with its lowest and its highest place
    have = 1
    while have < windows:
        step = min(have, windows - have)
        ends = [np.minimum(e[:-step], e[step:]) for e in ends]
        have += step
    begin = np.arange(len(ends[0]))
    low, high = (ends[0] & np.uint64(1023)).astype(np.int64), 1023 - (ends[1] & np.uint64(1023)).astype(np.int64)
    return ends[0] >> np.uint64(10), begin + (low - begin & 1023), begin + (high - begin & 1023)


def _segments(length: int, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("mh", pa.int64()), ("sh", pa.int64()), ("again", pa.bool_()), ("route", pa.int64()), ("known", pa.bool_())])

    def emit(units: list[tuple[object, int, int, bytes]]) -> pa.RecordBatch:
        joined = b"".join(u[3] for u in units)
        data = np.frombuffer(joined, np.uint8)
        low, lowest, highest = _minimizers(data, GRAM, length - GRAM + 1)
        sizes = np.array([len(u[3]) for u in units])
        offsets = np.cumsum(sizes) - sizes
        counts = sizes - (length - 1)  # windows of each unit
        unit = np.repeat(np.arange(len(units)), counts)
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        window = offsets[unit] + at
        mins = low[window]
        new = np.ones(len(at), bool)
        new[1:] = (mins[1:] != mins[:-1]) | (unit[1:] != unit[:-1])
        first = np.flatnonzero(new)
        many = np.diff(np.r_[first, len(at)])
        if (many > RUN).any():
            pieces = -(-many // RUN)
            inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            whole = np.repeat(many, pieces)
            first = np.repeat(first, pieces) + inner * RUN
            many = np.minimum(RUN, whole - inner * RUN)
        again = lowest[window[first]] != highest[window[first + many - 1]]  # two places in one window, or in different ones
        mh, of = mins[first].view(np.int64), unit[first]
        begin = (offsets[of] + at[first]).tolist()
        digest, view = xxhash.xxh3_64_intdigest, memoryview(joined)
        sh = np.array([digest(view[b : b + m]) for b, m in zip(begin, (many + length - 1).tolist())], np.uint64).view(np.int64)
        order = np.argsort(mh, kind="stable")
        same = np.r_[False, mh[order][1:] == mh[order][:-1]]
        later, known = np.zeros(len(mh), bool), np.zeros(len(mh), bool)
        later[order] = same
        known[order] = same | np.r_[same[1:], False]
        known |= again
        start = at[first] + np.array([u[2] for u in units])[of]
        route = np.where(later, sh ^ (start * np.int64(0x9E3779B1)) ^ np.array([u[1] for u in units], np.int64)[of], mh)
        return pa.RecordBatch.from_arrays(
            [pa.array([units[i][0] for i in of.tolist()], id_type), pa.array(np.array([u[1] for u in units], np.int64)[of]), pa.array(start), pa.array(many.astype(np.int32)), pa.array(mh), pa.array(sh), pa.array(again), pa.array(route), pa.array(known)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, held = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py()
                if text is None or len(text) < length:
                    continue
                id_, th = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                for begin in range(0, len(text) - length + 1, CHUNK):
                    part = text[begin : begin + CHUNK + length - 1]
                    units.append((id_, th, begin, part))
                    held += len(part)
                    if held >= CHUNK:
                        yield emit(units)
                        units, held = [], 0
        if units:
            yield emit(units)

    return run


def _repeated_minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route: drops those whose minimizer is alone. A batch at a time, as many rows may have one minimizer."""
    last, pending = None, None  # the minimizer seen last, and its row if nothing is known to keep it yet
    for batch in batches:
        mh, route = batch.column("mh").to_numpy(), batch.column("route").to_numpy()
        keep = np.array(batch.column("known").to_numpy(zero_copy_only=False), bool)
        rows = batch.select([c for c in batch.schema.names if c not in ("route", "known")])
        stands = np.flatnonzero(mh == route)  # rows that are here for their minimizer
        if len(stands):
            m = mh[stands]
            same = np.r_[last is not None and bool(m[0] == last), m[1:] == m[:-1]]
            if pending is not None and same[0]:
                yield pending
            keep[stands] |= same | np.r_[same[1:], False]
            last, pending = m[-1], None if keep[stands[-1]] else rows.slice(stands[-1], 1)
        yield rows.filter(pa.array(keep))


def _cut_segments(length: int, id_type: pa.DataType):
    """Joined rows (id, th, text, segs) -> (mh, copies, id, th, start, bytes)."""
    schema = pa.schema([("mh", pa.int64()), ("copies", pa.int64()), ("id", id_type), ("th", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])

    def make(cols: dict[str, list]) -> dict[str, object]:
        rows = [(s["mh"], s["copies"], i, t, s["start"], text[s["start"] : s["start"] + s["n"] + length - 1]) for i, t, text, segs in zip(cols["id"], cols["th"], cols["text"], cols["segs"]) for s in segs]
        return {f.name: [r[k] for r in rows] for k, f in enumerate(schema)}

    return over_rows(make, schema, 64)


def _sort_buckets(length: int, keep: str, id_type: pa.DataType):
    """Rows sorted by (mh, id, th, start) -> (id, th, low, high): byte ranges to remove."""
    schema = pa.schema([("id", id_type), ("th", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    def emit(rows: pa.Table) -> pa.RecordBatch:
        ids, ths, begins = (rows.column(c).to_pylist() for c in ("id", "th", "start"))
        once = [i for i in range(len(ids)) if not i or (ids[i], ths[i], begins[i]) != (ids[i - 1], ths[i - 1], begins[i - 1])]
        rows = rows.take(pa.array(once)) if len(once) < len(ids) else rows  # repeated rows of the input
        blobs = rows.column("bytes").to_pylist()
        data = np.frombuffer(b"".join(blobs), np.uint8)
        sizes = np.array([len(b) for b in blobs])
        counts = sizes - (length - 1)
        of = np.repeat(np.arange(len(blobs)), counts)
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        earlier, any_ = repeated_windows(data, (np.cumsum(sizes) - sizes)[of] + at, length)
        hit = np.flatnonzero(earlier if keep == "first" else any_)
        start = rows.column("start").to_numpy()
        new = np.r_[True, (of[hit][1:] != of[hit][:-1]) | (at[hit][1:] != at[hit][:-1] + 1)][: len(hit)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:] - 1, len(hit) - 1][: len(first)]
        a, b = hit[first], hit[last]
        owner = pa.array(of[a])
        return pa.RecordBatch.from_arrays([rows.column("id").combine_chunks().take(owner), rows.column("th").combine_chunks().take(owner), pa.array(start[of[a]] + at[a]), pa.array(start[of[b]] + at[b] + length)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for table in sorted_groups(batches, "mh"):
            if held and size + table.nbytes > CHUNK:
                yield emit(pa.concat_tables(held))
                held, size = [], 0
            held.append(table)
            size += table.nbytes
        if held:
            yield emit(pa.concat_tables(held))

    return run


def _window_hashes(length: int, id_type: pa.DataType):
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("id", id_type), ("th", pa.int64()), ("pos", pa.int64())])

    def make(cols: dict[str, list]) -> dict[str, object]:
        rows = []
        for id_, th, start, data in zip(cols["id"], cols["th"], cols["start"], cols["bytes"]):
            for i in range(len(data) - length + 1):
                both = xxhash.xxh3_128_intdigest(data[i : i + length])
                rows.append(((both >> 64) - (1 << 63), (both & (1 << 64) - 1) - (1 << 63), id_, th, start + i))
        return {f.name: [r[k] for r in rows] for k, f in enumerate(schema)}

    return over_rows(make, schema, 1024)


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.withColumn("_r_th", F.xxhash64(F.col(text_col))).withColumn("_r_id", F.col(id_col)).withColumn("_r_text", F.col(text_col).cast("binary"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["_r_id"].eqNullSafe(b["id"]) & (a["_r_th"] == b["th"])


def repeat_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: str = "none", hot: int = 16384) -> DataFrame:
    """(id, th, low, high): byte ranges to remove, which may overlap; th is xxhash64 of the text, so rows of one id are told apart.

    Texts are UTF-8 bytes; null, empty and shorter texts have no ranges. Matches never cross texts. Rows with one id and
    one text count as different places for keep="none" and as one for keep="first".
    """
    docs = _keyed(df, id_col, text_col).select(F.col("_r_id"), F.col("_r_th"), F.col("_r_text"))
    id_type, id_name = _arrow_type(docs, "_r_id"), docs.schema["_r_id"].dataType.simpleString()
    found = docs.select(F.col("_r_id").alias("id"), F.col("_r_th").alias("th"), F.col("_r_text").alias("text")).mapInArrow(frugal(_segments(length, id_type)), f"id {id_name}, th long, start long, n int, mh long, sh long, again boolean, route long, known boolean")
    rows = stored(found.repartition("route").sortWithinPartitions("route").mapInArrow(frugal(_repeated_minimizers), f"id {id_name}, th long, start long, n int, mh long, sh long, again boolean"), "segments")
    kinds = rows.groupBy("mh", "sh").agg(F.count("*").alias("copies"), F.max("again").alias("again"), F.min(F.struct("id", "th", "start", "n")).alias("first"))
    mixed = kinds.groupBy("mh").agg(F.count("*").alias("kinds"), F.max("again").alias("any_again")).where("kinds > 1 or any_again")
    several = kinds.where("copies > 1")
    # one of equal segments, where its minimizer has others
    stand = kinds.join(mixed, "mh").select("mh", "copies", "kinds", "first.*")
    wanted = stand.groupBy("id", "th").agg(F.collect_list(F.struct("mh", F.when(F.col("kinds") > hot, -F.col("copies")).otherwise(F.col("copies")).alias("copies"), "start", "n")).alias("segs"))
    cut = docs.join(wanted, _same(docs, wanted)).select("id", "th", F.col("_r_text").alias("text"), "segs").mapInArrow(frugal(_cut_segments(length, id_type)), f"mh long, copies long, id {id_name}, th long, start long, bytes binary")
    cut = stored(cut, "edges")
    sorted_ = cut.where("copies > 0").repartition("mh").sortWithinPartitions("mh", "id", "th", "start").mapInArrow(frugal(_sort_buckets(length, keep, id_type)), f"id {id_name}, th long, low long, high long")
    windows = cut.where("copies < 0").mapInArrow(_window_hashes(length, id_type), f"w1 long, w2 long, id {id_name}, th long, pos long").distinct()
    classes = windows.groupBy("w1", "w2").agg(F.count("*").alias("many"), F.min(F.struct("id", "th", "pos")).alias("head")).where("many > 1")
    again = windows.join(classes, ["w1", "w2"])
    if keep == "first":
        again = again.where(~F.struct("id", "th", "pos").eqNullSafe(F.col("head")))
    again = again.select("id", "th", F.col("pos").alias("low"), (F.col("pos") + length).alias("high"))
    whole = rows.join(several, ["mh", "sh"])
    if keep == "first":
        whole = whole.where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th")) & (F.col("start") == F.col("first.start"))))
    whole = whole.select("id", "th", F.col("start").alias("low"), (F.col("start") + F.col("n") + (length - 1)).alias("high"))
    return whole.unionByName(sorted_).unionByName(again)


def cut_text(text: bytes | None, spans: list[dict] | None) -> tuple[bytes, int, int, int]:
    """(what is left, bytes, bytes removed, runs removed) of a text without the ranges, which may overlap."""
    text = text or b""
    if not spans:
        return text, len(text), 0, 0
    parts, end, removed, runs = [], 0, 0, 0
    for low, high in sorted((s["low"], s["high"]) for s in spans):
        if low > end or not runs:
            parts.append(text[end:low])
            runs += 1
            removed += high - low
        else:
            removed += max(0, high - end)
        end = max(end, high)
    parts.append(text[end:])
    return b"".join(parts), len(text), removed, runs


def _remove(id_type: pa.DataType):
    schema = pa.schema([("_r_id", id_type), ("_r_th", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def make(cols: dict[str, list]) -> dict[str, object]:
        done = [cut_text(t, s) for t, s in zip(cols["text"], cols["spans"])]
        return {"_r_id": cols["_r_id"], "_r_th": cols["_r_th"], **{n: [d[k] for d in done] for k, n in enumerate(("kept", "n_bytes", "n_removed", "n_spans"))}}

    return over_rows(make, schema, 128)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: str = "none") -> DataFrame:
    """(id_col, kept binary, n_bytes, n_removed, n_spans) for each row of df: its text as UTF-8 without the ranges of repeat_spans(); null counts as empty."""
    docs = _keyed(df.select(F.col(id_col), F.col(text_col)), id_col, text_col).select("_r_id", "_r_th", "_r_text")
    spans = repeat_spans(df, id_col, text_col, length, keep).groupBy("id", "th").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    id_type, id_name = _arrow_type(docs, "_r_id"), docs.schema["_r_id"].dataType.simpleString()
    joined = docs.join(spans, _same(docs, spans), "left").select("_r_id", "_r_th", F.col("_r_text").alias("text"), "spans")
    return joined.mapInArrow(frugal(_remove(id_type)), f"_r_id {id_name}, _r_th long, kept binary, n_bytes long, n_removed long, n_spans long").drop("_r_th").withColumnRenamed("_r_id", id_col)


def without_later_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """df with texts that lack later copies (keep="first"); a character of which a byte goes, goes whole. Null texts stay null. Other columns stay."""
    keyed = _keyed(df, id_col, text_col)
    spans = repeat_spans(df, id_col, text_col, length, "first").groupBy("id", "th").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = keyed.join(spans, _same(keyed, spans), "left").select(*(F.col(c) for c in df.columns if c != text_col), F.col(text_col).alias("text"), "spans")
    names = [f"c{i}" for i in range(len(joined.columns))]
    rows = joined.toDF(*names)
    schema = pa.schema([(n, _arrow_type(rows, n)) for n in names[:-1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                *rest, texts, found = batch.slice(at, 256).columns
                if found.null_count < len(found):
                    texts = pa.array([t if s is None or t is None else cut_text(t.encode(), s)[0].decode("utf-8", "ignore") for t, s in zip(texts.to_pylist(), found.to_pylist())], texts.type)
                yield pa.RecordBatch.from_arrays([*rest, texts], schema=schema)

    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names[:-1])
    return rows.mapInArrow(frugal(run), kinds).toDF(*(c for c in df.columns if c != text_col), text_col).select(*df.columns)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(read_table(spark, sf_dir, "documents"), keep="none")
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400)),
c AS (SELECT doc_id, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
s AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM c)),
r AS (SELECT doc_id, g, min(i) AS low, max(i) + 200 AS high FROM s GROUP BY ALL),
k AS (SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS after FROM r),
t AS (SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last, string_agg(substr(h, 2 * after + 1, 2 * (low - after)), '' ORDER BY low) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * CAST(coalesce(last, 0) AS BIGINT) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
