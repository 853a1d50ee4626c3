"""SpotSigs document fingerprints, in DataFrame operations only.

A signature is the chain of the next content words after an anchor (a common word of one of four languages), anchors
between them left out. A document's fingerprint is the sorted set of the 32-bit hashes of its signatures. A text
without a whole chain has one signature over all its words; a text without words has none.

The likeness of two fingerprints is the Jaccard similarity of the sets. It is at most the smaller length by the larger,
so sets are put into classes by length, and pairs whose lengths alone rule out the threshold are never compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table

ANCHORS = {
    "en": "a an and are as be by for in is it of on or that the this to was with",
    "fr": "au aux ce dans de des du en est et la le les par pour que qui sur un une",
    "de": "als auf das dem den der des die ein eine für im in ist mit nicht und von zu zum",
    "es": "al como con de del el en es la las los para por que se su un una y",
}
CHAIN = 2
THRESHOLD = 0.8


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted set of a text's signature hashes, as array<int>; null counts as empty."""
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    anchors = "|".join(sorted({w for line in ANCHORS.values() for w in line.split()}))
    marked = F.regexp_replace(words, rf"(?<= )(?:{anchors})(?= )", "\u0001")
    # Only the last of several anchors in a row is looked at, as all have the same chain. No group repeats, so the depth of the match is bounded.
    spans = F.regexp_extract_all(marked, F.lit("\u0001(?= (" + "[\u0001 ]+".join(["[^\u0001 ]+"] * chain) + "))"), F.lit(1))
    found = F.array_sort(F.array_distinct(F.transform(spans, lambda s: F.hash(F.regexp_replace(s, "[\u0001 ]+", " ")))))
    whole = F.trim(words)
    # bound to a variable, as a column used twice here would be evaluated twice
    return F.transform(F.array(found), lambda f: F.when(F.size(f) > 0, f).when(whole != "", F.array(F.hash(whole))).otherwise(F.array().cast("array<int>")))[0]


def fingerprint(signature_set: Column) -> Column:
    """Eight hex digits a signature, in order."""
    return F.concat_ws("", F.transform(signature_set, lambda s: F.lower(F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))))


def length_class(signature_set: Column, threshold: float = THRESHOLD) -> Column:
    """Sets that are alike by the threshold are in the same class or in neighbouring ones."""
    return F.floor(F.log(F.greatest(F.size(signature_set), F.lit(1)).cast("double")) / F.lit(-math.log(threshold))).cast("long")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 1 if both are empty, and 0 without a comparison where their lengths rule out the threshold or the result is below it."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = common / (small + large - common)
    bound = F.when(large == 0, F.lit(1.0)).when((small == 0) | (small < large * F.lit(threshold)), F.lit(0.0))
    return F.coalesce(bound, F.when(exact >= threshold, exact).otherwise(F.lit(0.0)))


def similar_pairs(queries: DataFrame, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(query_id, id, likeness) for each row of df that is alike a query by the threshold (above 0), itself included.

    Sets are partitioned by length class, and a query visits its own class and the neighbours. Two sets as alike as that
    share one of the first size - ceil(threshold * size) + 1 hashes of each, so only those are joined on; what the lengths
    rule out is not compared. The search is exact. Texts without words (null, empty) are alike nothing.
    """
    shape = lambda d, i, s: d.select(F.col(id_col).alias(i), signatures(F.col(text_col)).alias(s)).where(F.size(s) > 0)
    head = lambda s: F.explode(F.slice(s, F.lit(1), F.size(s) - F.ceil(F.size(s) * threshold - 1e-9).cast("int") + 1))
    own = length_class(F.col("q_set"), threshold)
    asked = shape(queries, "query_id", "q_set").withColumn("class", F.explode(F.array(own - 1, own, own + 1))).withColumn("sig", head(F.col("q_set")))
    held = shape(df, "id", "set").withColumn("class", length_class(F.col("set"), threshold)).withColumn("sig", head(F.col("set")))
    met = asked.join(held, ["class", "sig"]).dropDuplicates(["query_id", "id", "q_set", "set"])
    return met.withColumn("likeness", likeness(F.col("q_set"), F.col("set"), threshold)).where("likeness > 0").select("query_id", "id", "likeness")


def _ranges(docs: DataFrame) -> Column:
    """The number of the range of ids that a row's id is in; nulls are in the first. Of docs, one id for each range comes to the driver."""
    spark = docs.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = docs.select("id").repartitionByRange(min(8 * shuffled, max(shuffled, 4096)), "id").groupBy(F.spark_partition_id()).agg(F.min("id").alias("id"))
    bounds = sorted({r.id for r in heads.collect()} - {None})
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length())][::-1]
    ordered, step = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, steps))
    at = lambda pos, more: F.try_element_at(ordered, pos + more)
    return F.aggregate(step, F.lit(0), lambda pos, more: F.when(at(pos, more) <= F.col("id"), pos + more).otherwise(pos))


def with_next_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, text, set, next_text, next_set) for each different (id, text), n being how often it came: the text and signatures of it and of the next by id and hash of the text, after the last the first.

    Texts are shuffled once, by ranges of ids; within a range the next is the next row, and the last takes the first of the next
    range from a table with one row a range.
    """
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("part", _ranges(docs))
    different = docs.repartition("part").groupBy("part", "id", "th").agg(F.count("*").alias("n"), F.first("text").alias("text")).withColumn("set", signatures(F.col("text")))
    order = Window.partitionBy("part").orderBy("id", "th")
    inside = different.withColumn("next", F.lead(F.struct("text", "set")).over(order))
    by_part = Window.orderBy("part")
    heads = docs.groupBy("part").agg(F.min(F.struct("id", "th")).alias("head")).withColumn("of", F.coalesce(F.lag("part").over(by_part), F.max("part").over(Window.partitionBy())))
    heads = heads.select("of", F.col("head.id").alias("head_id"), F.col("head.th").alias("head_th"))
    firsts = docs.join(heads, F.col("id").eqNullSafe(F.col("head_id")) & (F.col("th") == F.col("head_th"))).groupBy("of").agg(F.first("text").alias("t")).select("of", F.struct(F.col("t").alias("text"), signatures(F.col("t")).alias("set")).alias("first"))
    joined = inside.join(firsts, F.col("part") == F.col("of"), "left").withColumn("next", F.coalesce("next", "first"))
    return joined.select("id", "n", "text", "set", F.col("next.text").alias("next_text"), F.col("next.set").alias("next_set"))


def compare_with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: its fingerprint, that of its edited text (its second half replaced by the head of the next document),
    and the likeness of its fingerprint to those of the edited text and of the next document.

    Null texts count as empty. Rows with one id and one text are one document, and come back as often as they came. A table of one document is its own next.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    made = with_next_documents(df, id_col, text_col).withColumn("half", half).withColumn("n_chars", F.char_length("text"))
    made = made.withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - half)"), F.expr("substring(next_text, 1, half)")))
    made = made.select("id", "n", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("set").alias("own_set"), signatures(F.col("edited")).alias("edited_set"), "next_set")
    made = made.select(
        F.col("id").alias(id_col), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", fingerprint(F.col("own_set")).alias("fingerprint"), fingerprint(F.col("edited_set")).alias("edited_fingerprint"),
        likeness(F.col("own_set"), F.col("edited_set")).alias("near_edited"), likeness(F.col("own_set"), F.col("next_set")).alias("near_next"), length_class(F.col("own_set")).alias("length_class"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("again"),
    )
    return made.drop("again")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(read_table(spark, sf_dir, "documents"))


#: The same by words in order, one row a word. Hashes are Spark's hash() of a string, 32-bit Murmur3 with seed 42, folded over
#: four bytes at a time and then the one to three left over, each as a signed number.
OP9_SQL = rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
after AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text, coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id FROM t),
made AS (SELECT *, substring(text, 1, n - n // 2) || substring(next_text, 1, n // 2) AS edited FROM after),
words AS (SELECT doc_id, kind, list_filter(string_split_regex(lower(body), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS ws FROM (SELECT doc_id, 0 AS kind, text AS body FROM made UNION ALL SELECT doc_id, 1, edited FROM made)),
placed AS (SELECT doc_id, kind, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
told AS (SELECT *, w IN ({", ".join(f"'{w}'" for w in sorted({w for line in ANCHORS.values() for w in line.split()}))}) AS anchor FROM placed),
led AS (SELECT *, lag(anchor) OVER (PARTITION BY doc_id, kind ORDER BY i) AS led FROM told),
content AS (SELECT doc_id, kind, led, w, lead(w) OVER (PARTITION BY doc_id, kind ORDER BY i) AS w2 FROM led WHERE NOT anchor),
chains AS (SELECT DISTINCT doc_id, kind, w || ' ' || w2 AS sig FROM content WHERE led AND w2 IS NOT NULL),
sigs AS (FROM chains UNION ALL SELECT doc_id, kind, array_to_string(ws, ' ') FROM words ANTI JOIN chains USING (doc_id, kind) WHERE len(ws) > 0),
bytes AS (SELECT sig, hex(sig) AS x, length(hex(sig)) // 2 AS n FROM (SELECT DISTINCT sig FROM sigs)),
parts AS (SELECT sig, n, list_concat(
 list_transform(range(n // 4), lambda k: CAST('0x' || substring(x, 8 * k + 7, 2) || substring(x, 8 * k + 5, 2) || substring(x, 8 * k + 3, 2) || substring(x, 8 * k + 1, 2) AS BIGINT)),
 list_transform(range(n - n % 4, n), lambda k: (CAST('0x' || substring(x, 2 * k + 1, 2) AS BIGINT) + 128) % 256 + 4294967168)) AS ks FROM bytes),
mixed AS (SELECT sig, n, list_transform(list_transform(ks, lambda k: CAST(k % 4294967296 AS UBIGINT) * 3432918353 % 4294967296), lambda k: (((k * 32768) % 4294967296) + k // 131072) * 461845907 % 4294967296) AS ks FROM parts),
folded AS (SELECT sig, xor(list_reduce(list_prepend(CAST(42 AS UBIGINT), ks), lambda h, k: ((((xor(h, k) * 8192) % 4294967296) + xor(h, k) // 524288) * 5 + 3864292196) % 4294967296), CAST(n AS UBIGINT)) AS h FROM mixed),
last1 AS (SELECT sig, xor(h, h // 65536) * 2246822507 % 4294967296 AS h FROM folded),
last2 AS (SELECT sig, xor(h, h // 8192) * 3266489909 % 4294967296 AS h FROM last1),
hashed AS (SELECT sig, xor(h, h // 65536) AS u FROM last2),
sets AS (SELECT doc_id, kind, list_sort(list(DISTINCT CASE WHEN u < 2147483648 THEN CAST(u AS BIGINT) ELSE CAST(u AS BIGINT) - 4294967296 END)) AS s FROM sigs JOIN hashed USING (sig) GROUP BY ALL),
paired AS (SELECT m.doc_id, m.n, m.edited, coalesce(a.s, []) AS a, coalesce(b.s, []) AS b, coalesce(c.s, []) AS c FROM made m LEFT JOIN sets a ON a.doc_id = m.doc_id AND a.kind = 0 LEFT JOIN sets b ON b.doc_id = m.doc_id AND b.kind = 1 LEFT JOIN sets c ON c.doc_id = m.next_id AND c.kind = 0)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
 array_to_string(list_transform(a, lambda h: printf('%08x', (h + 4294967296) % 4294967296)), '') AS fingerprint, array_to_string(list_transform(b, lambda h: printf('%08x', (h + 4294967296) % 4294967296)), '') AS edited_fingerprint,
 CASE WHEN len(a) + len(b) = 0 THEN 1.0 ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) / (len(a) + len(b) - len(list_intersect(a, b))) END AS near_edited,
 CASE WHEN len(a) + len(c) = 0 THEN 1.0 ELSE CAST(len(list_intersect(a, c)) AS DOUBLE) / (len(a) + len(c) - len(list_intersect(a, c))) END AS near_next,
 CAST(floor(ln(greatest(len(a), 1)) / {-math.log(THRESHOLD)!r}) AS BIGINT) AS length_class FROM paired"""
