"""The registered queries of the citation engine: name -> query, name -> SQL with the same result.

The domain's operators run on the driver's tables through analogues: customers are sources, orders are runs, line items
are resolved references, return flags are comparison states, events are telemetry.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import compare, history, ordered, quantiles, routing, store, telemetry

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        if sql is not None:
            _SQL[query.__name__] = sql
        return query

    return add


# Analogues -----------------------------------------------------------------


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PARSER_SQL = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'arXiv' WHEN 'BUILDING' THEN 'CrossRef' WHEN 'MACHINERY' THEN 'Arthur' ELSE c_mktsegment END"
SOURCE_SQL = f"(SELECT c_custkey AS bibcode, 'file' || (c_custkey % 7) AS source_filename, {PARSER_SQL} AS parser_name FROM customer)"
HISTORY_SQL = "(SELECT o_orderkey AS id, o_custkey AS bibcode, 'file' || (o_custkey % 7) AS source_filename, o_orderdate AS date FROM orders)"
RESOLVED_SQL = "(SELECT l_orderkey AS history_id, l_linenumber AS item_num, l_partkey AS bibcode, l_discount AS score FROM lineitem)"
STATE_SQL = "CASE l_returnflag WHEN 'A' THEN 'MATCH' WHEN 'N' THEN 'MISS' ELSE 'DIFF' END"


def _source(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "customer").select(F.col("c_custkey").alias("bibcode"), F.expr("concat('file', c_custkey % 7)").alias("source_filename"), F.lit(None).cast("string").alias("resolved_filename"), F.expr(PARSER_SQL).alias("parser_name"))


def _history(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("bibcode"), F.expr("concat('file', o_custkey % 7)").alias("source_filename"), F.col("o_orderdate").alias("source_modified"), F.col("o_orderdate").alias("date"))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("history_id"), F.col("l_linenumber").alias("item_num"), F.col("l_partkey").alias("bibcode"), F.col("l_discount").alias("score"))


# Rankings ------------------------------------------------------------------


def _ranking(query: Callable, spark: SparkSession, d: str, **options) -> DataFrame:
    found = query(_resolved(spark, d), _history(spark, d), _source(spark, d), **options)
    return found.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def _ranking_sql(keys: str, priority: bool, strict: bool = False, ascending: bool = False) -> str:
    case = "CASE WHEN parser_name IN ('arXiv', 'CrossRef') THEN 1 WHEN parser_name = 'Arthur' THEN 3 ELSE 2 END"
    order = (f"{case} {'ASC' if ascending else 'DESC'}, " if priority else "") + "score DESC, history_id DESC, item_num ASC, parser_name ASC, date DESC"
    return f"""SELECT source_bibcode, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, item_num AS id, resolved_bibcode, score, parser_name{', ' + case + ' AS parser_priority' if priority else ''}
FROM (SELECT s.bibcode AS source_bibcode, h.date, r.item_num, r.bibcode AS resolved_bibcode, r.score, s.parser_name, r.history_id,
  row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n
  FROM {RESOLVED_SQL} r JOIN {HISTORY_SQL} h ON h.id = r.history_id JOIN {SOURCE_SQL} s ON s.bibcode = h.bibcode{' AND s.source_filename = h.source_filename' if strict else ''} WHERE r.score <> 0) WHERE n = 1"""


@register(_ranking_sql("s.bibcode, r.bibcode", True))
def best_resolved_by_priority(spark, d):
    return _ranking(history.best_by_priority, spark, d)


@register(_ranking_sql("s.bibcode, r.bibcode", True, ascending=True))
def best_resolved_lowest_priority(spark, d):
    return _ranking(history.best_by_priority, spark, d, ascending=True)


@register(_ranking_sql("s.bibcode, s.parser_name, r.bibcode", False))
def best_resolved_by_parser(spark, d):
    return _ranking(history.best_by_parser, spark, d)


@register(_ranking_sql("s.bibcode, s.parser_name, r.bibcode", False, strict=True))
def best_resolved_by_parser_strict(spark, d):
    return _ranking(history.best_by_parser, spark, d, strict=True)


@register(_ranking_sql("s.bibcode, r.bibcode", True) + " AND source_bibcode = 7")
def best_resolved_of_one_source(spark, d):
    return _ranking(history.best_by_priority, spark, d, source_bibcode=7)


# Run summaries and diagnostics ---------------------------------------------

SUMMARY_SQL = "SELECT max(bibcode) AS bibcode, max(source_filename) AS source_filename, count(bibcode) AS num_runs, strftime(max(date), '%Y-%m-%d') AS last_run_date, max(id) AS history_id FROM {0} {1} GROUP BY {2}"
_dated = lambda df: df.withColumn("last_run_date", F.date_format("last_run_date", "yyyy-MM-dd"))


@register(SUMMARY_SQL.format(HISTORY_SQL, "", "bibcode"))
def run_summary_by_source(spark, d):
    return _dated(history.run_summary(_history(spark, d)))


@register(SUMMARY_SQL.format(HISTORY_SQL, "", "source_filename"))
def run_summary_by_filename(spark, d):
    return _dated(history.run_summary(_history(spark, d), "source_filename"))


@register(SUMMARY_SQL.format(HISTORY_SQL, "WHERE bibcode IN (3, 5, 8) AND source_filename IN ('file3', 'file5')", "bibcode"))
def run_summary_filtered(spark, d):
    return _dated(history.run_summary(_history(spark, d), "bibcode", [3, 5, 8], ["file3", "file5"]))


@register(SUMMARY_SQL.format(HISTORY_SQL, "", "id") + " ORDER BY history_id LIMIT 10")
def run_summary_first10(spark, d):
    return _dated(history.first_runs(_history(spark, d)))


RESOLVED_COUNTS_SQL = f"SELECT history_id, count(item_num) AS last_run_num_references, count(score) FILTER (WHERE score > 0) AS last_run_num_resolved_references FROM {RESOLVED_SQL} GROUP BY history_id"


@register(RESOLVED_COUNTS_SQL)
def resolved_counts(spark, d):
    return history.resolved_counts(_resolved(spark, d))


@register(RESOLVED_COUNTS_SQL.replace("GROUP BY", "WHERE history_id IN (SELECT o_orderkey FROM orders WHERE o_custkey = 11) GROUP BY"))
def resolved_counts_of_runs(spark, d):
    return history.resolved_counts(_resolved(spark, d), _history(spark, d).where("bibcode = 11").select(F.col("id").alias("history_id")))


@register("SELECT 'ReferenceSource' AS name, 'source reference file information' AS description, count(*) AS count FROM customer UNION ALL SELECT 'ProcessedHistory', 'top level information for a processed run', count(*) FROM orders UNION ALL SELECT 'ResolvedReference', 'resolved reference information for a processed run', count(*) FROM lineitem UNION ALL SELECT 'CompareClassic', 'comparison of new and classic processed run', count(*) FROM part")
def table_counts(spark, d):
    return history.table_counts({"reference_source": _source(spark, d), "processed_history": _history(spark, d), "resolved_reference": _resolved(spark, d), "compare_classic": _read(spark, d, "part")})


@register(f"""WITH runs AS (SELECT bibcode, count(*) AS num_runs, max(date) AS last_run_date, max(id) AS history_id FROM {HISTORY_SQL} GROUP BY bibcode), counts AS ({RESOLVED_COUNTS_SQL}), src AS (SELECT * FROM {SOURCE_SQL} WHERE bibcode % 3 <> 0)
SELECT coalesce(s.bibcode, r.bibcode) AS bibcode, 'file' || (coalesce(s.bibcode, r.bibcode) % 7) AS source_filename, parser_name, num_runs, strftime(last_run_date, '%Y-%m-%d') AS last_run_date, r.history_id, last_run_num_references, last_run_num_resolved_references FROM src s FULL JOIN runs r ON s.bibcode = r.bibcode LEFT JOIN counts c ON c.history_id = r.history_id""")
def diagnostics_merge(spark, d):
    return _dated(history.diagnostics(_source(spark, d).where("bibcode % 3 <> 0"), _history(spark, d), _resolved(spark, d))).drop("resolved_filename")


# Reprocessing --------------------------------------------------------------

NOW = dt.datetime(2001, 8, 2)
FAKE_BIB = "lpad(cast(1990 + {0} % 20 as varchar), 4, '0') || CASE {0} % 3 WHEN 0 THEN 'A&A..' WHEN 1 THEN 'ApJ..' ELSE 'MNRAS' END || lpad(cast({0} as varchar), 9, '.') || 'A'"
REPROCESS_SQL = f"""SELECT r.history_id, r.item_num, r.refstr, h.bibcode AS source_bibcode, h.source_filename, s.parser_name
FROM (SELECT l_orderkey AS history_id, l_linenumber AS item_num, 'ref ' || l_partkey AS refstr, l_discount AS score, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN '0000' ELSE {FAKE_BIB.format('l_partkey')} END AS bibcode, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN -1 ELSE round(l_discount, 2) END AS sc FROM lineitem) r
JOIN {HISTORY_SQL} h ON h.id = r.history_id JOIN {SOURCE_SQL} s ON s.bibcode = h.bibcode AND s.source_filename = h.source_filename WHERE """


def _reprocess(spark: SparkSession, d: str, kind: str, **options) -> DataFrame:
    queued = "l_returnflag = 'R' AND l_linestatus = 'O'"
    refs = _read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("history_id"), F.col("l_linenumber").alias("item_num"), F.expr("concat('ref ', l_partkey)").alias("reference_str"), F.lit(None).cast("string").alias("reference_raw"),
        F.expr(f"CASE WHEN {queued} THEN '0000' ELSE {FAKE_BIB.format('l_partkey').replace('varchar', 'string')} END").alias("bibcode"), F.expr(f"cast(CASE WHEN {queued} THEN -1 ELSE l_discount END AS decimal(10,4))").alias("score"),
    )
    return history.reprocess_rows(refs, _history(spark, d), _source(spark, d), kind, now=NOW, **options)


_shown = lambda df: df.select("history_id", "item_num", "refstr", "source_bibcode", "source_filename", "parser_name")


@register(REPROCESS_SQL + "sc <= 0.04")
def reprocess_by_score(spark, d):
    return _shown(_reprocess(spark, d, "score", score_cutoff=0.041))


@register(REPROCESS_SQL + "r.bibcode LIKE '____A&A..__________'")
def reprocess_by_bibstem(spark, d):
    return _shown(_reprocess(spark, d, "bibstem", match="A&A.."))


@register(REPROCESS_SQL + "r.bibcode LIKE '1995_______________'")
def reprocess_by_year(spark, d):
    return _shown(_reprocess(spark, d, "year", match="1995"))


@register(REPROCESS_SQL + "r.bibcode = '0000' AND sc = -1")
def reprocess_failed(spark, d):
    return _shown(_reprocess(spark, d, "failed"))


@register(REPROCESS_SQL + "sc <= 0.04 AND h.date >= TIMESTAMP '2001-08-02' - INTERVAL 400 DAY")
def reprocess_recent(spark, d):
    return _shown(_reprocess(spark, d, "score", score_cutoff=0.04, days=400))


@register(f"SELECT history_id, source_bibcode, source_filename, parser_name, count(*) AS n, string_agg(item_num || ':' || refstr, '|' ORDER BY item_num, refstr) AS refs FROM ({REPROCESS_SQL} sc <= 0.04) GROUP BY ALL")
def reprocess_batches(spark, d):
    batches = history.reprocess_batches(_reprocess(spark, d, "score", score_cutoff=0.04))
    refs = F.col("block_references")[0]["references"]
    return batches.select("history_id", "source_bibcode", "source_filename", "parser_name", F.size(refs).cast("long").alias("n"), F.array_join(F.transform(refs, lambda r: F.concat_ws(":", r["item_num"], r["refstr"])), "|").alias("refs"))


# Comparison ----------------------------------------------------------------


def _compared(spark: SparkSession, d: str) -> DataFrame:
    state = STATE_SQL
    return _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("history_id"), F.col("l_linenumber").alias("item_num"), F.col("l_suppkey").cast("string").alias("bibcode"), F.col("l_tax").alias("score"), F.expr(state).alias("state"))


def _stringly(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    runs = _history(spark, d).withColumn("bibcode", F.col("bibcode").cast("string"))
    refs = _resolved(spark, d).select("history_id", "item_num", F.expr("CASE WHEN score = 0 THEN '...' ELSE cast(bibcode AS string) END").alias("bibcode"), "score", F.expr("concat('ref ', bibcode)").alias("reference_str"))
    return runs, refs


TAGS_SQL = f"""SELECT c.history_id, c.item_num, max(CASE WHEN state = 'MATCH' THEN 'MATCH' END) AS "MATCH", max(CASE WHEN state = 'MISS' THEN 'MISS' END) AS "MISS", max(CASE WHEN state = 'NEW' THEN 'NEW' END) AS "NEW", max(CASE WHEN state = 'NEWU' THEN 'NEWU' END) AS "NEWU", max(CASE WHEN state = 'DIFF' THEN 'DIFF' END) AS "DIFF"
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE regexp_matches('1024', CAST(o_custkey AS VARCHAR))) i JOIN (SELECT l_orderkey AS history_id, l_linenumber AS item_num, {STATE_SQL} AS state FROM lineitem) c ON i.l_orderkey = c.history_id AND i.l_linenumber = c.item_num GROUP BY ALL"""


@register(TAGS_SQL)
def compare_tags_grid(spark, d):
    runs, refs = _stringly(spark, d)
    return compare.compare_tags(runs, refs, _compared(spark, d), bibcode="1024")


@register(f"""SELECT count(*) AS num_references, count(*) FILTER (NOT starts_with(r.bibcode, '.')) AS num_resolved FROM (SELECT l_orderkey AS history_id, l_linenumber AS item_num, CASE WHEN l_discount = 0 THEN '...' ELSE CAST(l_partkey AS VARCHAR) END AS bibcode FROM lineitem) r
JOIN (SELECT l_orderkey AS history_id, l_linenumber AS item_num FROM lineitem) c USING (history_id, item_num) JOIN ({TAGS_SQL}) t USING (history_id, item_num)""")
def compare_stats_totals(spark, d):
    runs, refs = _stringly(spark, d)
    return compare.grid_totals(compare.compare_grid(runs, refs, _compared(spark, d), bibcode="1024"))


COMPARE_CASE = """CASE c.score WHEN '5' THEN CASE WHEN s.b = repeat('.', 19) THEN 'UNVER' ELSE 'NEWU' END WHEN '1' THEN CASE WHEN upper(s.b) = upper(c.b) THEN 'MATCH' WHEN s.b <> repeat('.', 19) THEN 'DIFF' ELSE 'MISS' END WHEN '0' THEN CASE WHEN s.b <> repeat('.', 19) THEN 'NEW' ELSE 'NONE' END END"""
CLASSIC_SCORE = "CASE l_linenumber % 4 WHEN 0 THEN '5' WHEN 1 THEN '1' WHEN 2 THEN '0' ELSE '7' END"
SERVICE_BIB = "CASE WHEN l_discount < 0.03 THEN repeat('.', 19) ELSE 'bib' || (l_partkey % 5) END"


@register(f"SELECT score, b AS service, cb AS classic, state, count(*) AS n FROM (SELECT s.score, s.b, s.cb, {COMPARE_CASE.replace('c.score', 's.score').replace('c.b', 's.cb')} AS state FROM (SELECT {CLASSIC_SCORE} AS score, {SERVICE_BIB} AS b, 'BIB' || (l_suppkey % 5) AS cb FROM lineitem) s) GROUP BY ALL")
def compare_state(spark, d):
    rows = _read(spark, d, "lineitem").select(F.expr(CLASSIC_SCORE).alias("score"), F.expr(SERVICE_BIB).alias("service"), F.expr("'BIB' || (l_suppkey % 5)").alias("classic"))
    return rows.withColumn("state", compare.compare_state(F.col("service"), F.col("classic"), F.col("score"))).groupBy("score", "service", "classic", "state").agg(F.count("*").alias("n"))


@register(f"""WITH s AS (SELECT conv_id AS block, turn AS pos, role || length(coalesce(text, '')) AS b FROM conversations), c AS (SELECT conv_id AS block, turn AS pos, upper(role) || length(coalesce(text, '')) AS b, CASE turn % 3 WHEN 0 THEN '1' WHEN 1 THEN '5' ELSE '0' END AS score FROM conversations WHERE conv_id % 4 <> 0 OR turn > 0)
SELECT block, pos, s.b AS service_bibcode, c.b AS classic_bibcode, c.score AS classic_score, {COMPARE_CASE} AS state FROM s JOIN c USING (block, pos) WHERE block IN (SELECT a.block FROM (SELECT block, count(*) AS n FROM s GROUP BY block) a JOIN (SELECT block, count(*) AS n FROM c GROUP BY block) b ON a.block = b.block AND a.n = b.n)""")
def positional_compare(spark, d):
    rows = _read(spark, d, "conversations").select(F.col("conv_id").alias("block"), F.col("turn").alias("pos"), F.expr("role || length(coalesce(text, ''))").alias("bibcode"))
    classic = _read(spark, d, "conversations").where("conv_id % 4 <> 0 OR turn > 0").select(F.col("conv_id").alias("block"), F.col("turn").alias("pos"), F.expr("upper(role) || length(coalesce(text, ''))").alias("bibcode"), F.expr("CASE turn % 3 WHEN 0 THEN '1' WHEN 1 THEN '5' ELSE '0' END").alias("score"))
    return compare.positional_compare(rows, classic)


@register(f"""WITH RECURSIVE side AS (SELECT conv_id AS block, turn AS pos, role || (length(coalesce(text, '')) % 3) AS ref, 'b' || (turn % 2) AS sb, 'b' || (turn % 3) AS cb FROM conversations),
lists AS (SELECT block, list(struct_pack(pos, ref, b := sb) ORDER BY pos) AS ours, coalesce(list(struct_pack(pos, ref, b := cb) ORDER BY pos) FILTER (pos > 0), []) AS theirs FROM side GROUP BY block),
fold AS (SELECT block, ours, theirs, 0 AS k, CAST([] AS BIGINT[]) AS taken, CAST(NULL AS BIGINT) AS hit FROM lists
 UNION ALL SELECT block, ours, theirs, k, CASE WHEN hit IS NULL THEN taken ELSE list_append(taken, hit) END, hit FROM (
  SELECT block, ours, theirs, k + 1 AS k, taken, CAST(list_filter(range(1, len(theirs) + 1), lambda j: NOT list_contains(taken, j) AND (theirs[j].ref = ours[k + 1].ref OR theirs[j].b = ours[k + 1].b))[1] AS BIGINT) AS hit FROM fold WHERE k < len(ours)))
SELECT block, pos, s.b AS service_bibcode, c.b AS classic_bibcode, '1' AS classic_score, {COMPARE_CASE.replace('c.score', "'1'")} AS state FROM (SELECT block, ours[k].pos AS pos, ours[k] AS s, theirs[hit] AS c FROM fold WHERE hit IS NOT NULL)""")
def greedy_compare(spark, d):
    """The same sides, taken in order."""
    rows = _read(spark, d, "conversations")
    service = rows.select(F.col("conv_id").alias("block"), F.col("turn").alias("pos"), F.expr("role || (length(coalesce(text, '')) % 3)").alias("refstring"), F.expr("concat('b', turn % 2)").alias("bibcode"))
    classic = rows.where("turn > 0").select(F.col("conv_id").alias("block"), F.col("turn").alias("pos"), F.expr("role || (length(coalesce(text, '')) % 3)").alias("reference"), F.expr("concat('b', turn % 3)").alias("bibcode"), F.lit("1").alias("score"))
    return compare.greedy_compare(service, classic)


# Existence, routing --------------------------------------------------------


@register("SELECT c_custkey AS bibcode FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def source_exists(spark, d):
    return store.present(_source(spark, d).select("bibcode"), _read(spark, d, "orders").where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "bibcode"), ["bibcode"])


@register("SELECT c_custkey AS bibcode FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def source_missing(spark, d):
    return store.absent(_source(spark, d).select("bibcode"), _read(spark, d, "orders").where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "bibcode"), ["bibcode"])


RULES = [("BrandA", ".x", "/xml", "Brand#11", True, None, None), ("BrandB", ".y", "/text", "Brand#12", False, 1, 25), ("BrandC", ".y", "/text", "Brand#12", False, 26, 40), ("BrandD", ".y", "/text", "Brand#13", False, 1, 10), ("BrandE", ".z", "/xml", "Brand#21", False, 5, 9)]


def _rule_parsers(spark: SparkSession) -> DataFrame:
    rule = "named_struct('journal', journal, 'all_volume', all_volume, 'volume_begin', volume_begin, 'volume_end', volume_end, 'volume_number', cast(null as int), 'partial_bibcode', cast(null as string), 'volume_string', cast(null as string))"
    table = spark.createDataFrame(RULES, "name string, extension_pattern string, reference_service_endpoint string, journal string, all_volume boolean, volume_begin int, volume_end int")
    return table.select("name", "extension_pattern", "reference_service_endpoint", F.array(F.expr(rule)).alias("matches"))


@register("""WITH f AS (SELECT p_partkey, p_brand, p_size, CASE p_partkey % 3 WHEN 0 THEN '.x' WHEN 1 THEN '.y' ELSE '.z' END AS extension FROM part)
SELECT p_partkey, extension, CASE extension WHEN '.x' THEN 'BrandA' WHEN '.z' THEN 'BrandE' ELSE CASE WHEN p_brand = 'Brand#13' THEN 'BrandD' WHEN p_brand = 'Brand#12' AND p_size BETWEEN 1 AND 25 THEN 'BrandB' WHEN p_brand = 'Brand#12' AND p_size BETWEEN 26 AND 40 THEN 'BrandC' END END AS parser_name FROM f""")
def route_by_volume_range(spark, d):
    files = _read(spark, d, "part").select("p_partkey", F.expr("concat('a/', p_brand, '/', p_size, '/f', CASE p_partkey % 3 WHEN 0 THEN '.x' WHEN 1 THEN '.y' ELSE '.z' END)").alias("source_filename"))
    return routing.route(files, _rule_parsers(spark)).select("p_partkey", "extension", "parser_name")


@register("SELECT ext AS extension_pattern, min(p_name) AS name, min(p_type) AS reference_service_endpoint FROM (SELECT 'e' || (p_partkey % 1500) AS ext, p_name, p_type FROM part) GROUP BY ext HAVING count(*) = 1")
def unique_extension_parsers(spark, d):
    rows = _read(spark, d, "part").select(F.expr("'e' || (p_partkey % 1500)").alias("extension_pattern"), F.col("p_name").alias("name"), F.col("p_type").alias("reference_service_endpoint"), F.array("p_size").alias("matches"))
    return routing.unique_extension_parsers(rows).drop("matches")


@register("SELECT n_nationkey, n_name FROM nation WHERE regexp_matches('from NATION_1 to NATION_21 by way of NATION_3', n_name)")
def reversed_regex_filter(spark, d):
    runs = _read(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("bibcode"))
    return compare.runs_named(runs, bibcode="from NATION_1 to NATION_21 by way of NATION_3").withColumnRenamed("bibcode", "n_name")


# Telemetry -----------------------------------------------------------------

STAGE_CASE = "CASE event_type WHEN 'click' THEN 'record_wall' WHEN 'view' THEN 'parse_dispatch' WHEN 'purchase' THEN 'resolver_http' WHEN 'signup' THEN 'pre_resolved_db' ELSE 'ingest_enqueue' END"
NAME_CASE = "'src/' || CASE user_id % 4 WHEN 0 THEN 'arXiv' WHEN 1 THEN 'PASJ' ELSE 'ADS' END || '/0/f' || (user_id % 50) || CASE user_id % 5 WHEN 0 THEN '.raw' WHEN 1 THEN '.iop.xml' WHEN 2 THEN '.ocr.txt' WHEN 3 THEN '.a.xml' ELSE '.html' END"
EVENTS_SQL = f"""(SELECT epoch(ts) AS ts, {STAGE_CASE} AS stage, CASE WHEN event_id % 37 = 0 THEN 'error' ELSE 'ok' END AS status, value AS duration_ms, 'rec' || (event_id % 997) AS record_id, CASE event_id % 4 WHEN 0 THEN 1 ELSE event_id % 4 END AS records, value / CASE event_id % 4 WHEN 0 THEN 1 ELSE event_id % 4 END AS per_record_ms, {NAME_CASE} AS source_filename,
CASE user_id % 5 WHEN 0 THEN '.raw' WHEN 1 THEN '.iop.xml' WHEN 2 THEN '.ocr.txt' WHEN 3 THEN '.xml' ELSE '.html' END AS source_type, CASE WHEN user_id % 5 = 0 THEN CASE user_id % 4 WHEN 0 THEN 'raw_arxiv' WHEN 1 THEN 'raw_pasj_html' ELSE 'raw_adstxt' END END AS raw_subfamily, CASE WHEN user_id % 3 > 0 THEN 'p' || (user_id % 3) END AS parser_name FROM events)"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "events").select("event_id", "user_id", "value", "ts", F.expr(STAGE_CASE).alias("stage"), F.expr(NAME_CASE).alias("source_filename"))
    text = lambda c: F.lit(None).cast("string").alias(c)
    extra = F.struct("source_filename", F.expr("CASE WHEN user_id % 3 > 0 THEN 'p' || (user_id % 3) END").alias("parser_name"), text("source_bibcode"), text("input_extension"), text("source_type"), text("raw_subfamily"), text("run_mode"), text("name"), text("error"), text("error_type"), F.expr("cast(event_id % 4 AS int)").alias("record_count"))
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return telemetry.prepare(rows.select(seconds.alias("ts"), "stage", text("run_id"), text("context_id"), F.expr("'rec' || (event_id % 997)").alias("record_id"), F.col("value").alias("duration_ms"), F.expr("CASE WHEN event_id % 37 = 0 THEN 'error' ELSE 'ok' END").alias("status"), extra.alias("extra")))


def _stats_sql(value: str, prefix: str = "", p99: bool = True) -> str:
    pick = [f"count({value}) AS {prefix}count", f"round(min({value}), 6) AS {prefix}min", f"round(max({value}), 6) AS {prefix}max", f"round(avg({value}), 6) AS {prefix}mean", *(f"round(quantile_cont({value}, {q}), 6) AS {prefix}{n}" for n, q in (("p50", 0.5), ("p95", 0.95), *((("p99", 0.99),) if p99 else ())))]
    return ", ".join(pick)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(F.col(f.name), 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema))


MEASURES_SQL = ", ".join(_stats_sql(f"CASE WHEN stage {s} THEN {v} END", f"{n}_") for n, s, v in (("wall", "= 'record_wall'", "duration_ms"), ("parse", "= 'parse_dispatch'", "per_record_ms"), ("resolver", "= 'resolver_http'", "duration_ms"), ("db", "IN ('pre_resolved_db', 'post_resolved_db')", "per_record_ms")))


@register(f"SELECT stage, {_stats_sql('per_record_ms')} FROM {EVENTS_SQL} WHERE duration_ms IS NOT NULL GROUP BY stage")
def stage_latency(spark, d):
    return _rounded(telemetry.stage_latency(_events(spark, d)))


@register(f"SELECT stage, round(quantile_cont(duration_ms, 0.5), 6) AS p50, round(quantile_cont(duration_ms, 0.95), 6) AS p95, round(quantile_cont(duration_ms, 0.99), 6) AS p99 FROM {EVENTS_SQL} GROUP BY stage")
def stage_percentiles_by_bands(spark, d):
    return _rounded(quantiles.exact_percentiles(_events(spark, d), ["stage"], "duration_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99}))


@register(f"SELECT {MEASURES_SQL} FROM {EVENTS_SQL}")
def per_record_metrics(spark, d):
    return _rounded(telemetry.per_record_metrics(_events(spark, d)))


def _breakdown(by: str, key: str) -> None:
    def query(spark, d):
        return _rounded(telemetry.breakdown(_events(spark, d), by))

    query.__name__ = f"telemetry_by_{by}"
    register(f'SELECT {key} AS "group", count(DISTINCT source_filename) AS file_count, count(DISTINCT record_id) AS record_count, {MEASURES_SQL} FROM {EVENTS_SQL} WHERE duration_ms IS NOT NULL AND {key} IS NOT NULL GROUP BY 1')(query)


_breakdown("source_type", "source_type")
_breakdown("parser_name", "coalesce(parser_name, 'unknown')")
_breakdown("raw_subfamily", "raw_subfamily")


@register(f"SELECT count(DISTINCT source_filename) AS files_processed, CAST(coalesce(sum(records) FILTER (stage = 'ingest_enqueue'), 0) AS BIGINT) AS records_submitted, count(DISTINCT record_id) AS records_processed, count(*) FILTER (status <> 'ok') AS failures FROM {EVENTS_SQL}")
def telemetry_counts(spark, d):
    return telemetry.counts(_events(spark, d))


@register(f"SELECT stage, count(*) AS errors FROM {EVENTS_SQL} WHERE status <> 'ok' GROUP BY stage")
def errors_by_stage(spark, d):
    return telemetry.errors_by_stage(_events(spark, d))


@register(f"SELECT round(max(ts) - min(ts), 6) AS wall_clock_s, round(count(DISTINCT record_id) / (max(ts) - min(ts)) * 60, 6) AS overall_records_per_minute, 1.5::DOUBLE AS host_load_adjustment_factor, round(count(DISTINCT record_id) / (max(ts) - min(ts)) * 60 * 1.5, 6) AS load_adjusted_records_per_minute FROM {EVENTS_SQL}")
def throughput(spark, d):
    return _rounded(telemetry.throughput(_events(spark, d), mean_load=1.5))


@register(f"SELECT CASE WHEN count(DISTINCT source_filename) < 1000 THEN 'incomplete' ELSE 'complete' END AS status FROM {EVENTS_SQL}")
def completion_status(spark, d):
    return telemetry.completion_status(_events(spark, d), 1000)


@register(f"SELECT source_filename AS \"group\", round(quantile_cont(CASE WHEN stage = 'record_wall' THEN duration_ms END, 0.95), 6) AS wall_p95 FROM {EVENTS_SQL} GROUP BY 1 ORDER BY coalesce(quantile_cont(CASE WHEN stage = 'record_wall' THEN duration_ms END, 0.95), 0) DESC, 1 LIMIT 10")
def slowest_groups_top10(spark, d):
    return _rounded(telemetry.slowest(telemetry.breakdown(_events(spark, d), "source_filename")).select("group", "wall_p95"))


METRICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register(" UNION ALL ".join(f"SELECT '{m}' AS metric, {_stats_sql(m, p99=False)} FROM lineitem" for m in METRICS))
def metric_unpivot_stats(spark, d):
    return _rounded(telemetry.unpivot_stats(_read(spark, d, "lineitem"), METRICS))


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def event_props_json(spark, d):
    return _read(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@register(f"SELECT source_filename, source_type, raw_subfamily, count(*) AS n FROM {EVENTS_SQL} GROUP BY ALL")
def file_kinds(spark, d):
    rows = _read(spark, d, "events").select(F.expr(NAME_CASE).alias("source_filename"))
    name = F.col("source_filename")
    return rows.select("source_filename", X.source_type(name).alias("source_type"), X.raw_subfamily(name, F.lit(None).cast("string")).alias("raw_subfamily")).groupBy("source_filename", "source_type", "raw_subfamily").agg(F.count("*").alias("n"))


# Scalar functions on made-up citations --------------------------------------

CITATION = "'Smith ' || (l_partkey % 9) || ', A. ' || CASE l_linenumber % 3 WHEN 0 THEN '' ELSE '(' || (1990 + l_partkey % 30) || ')' END || ' ApJ, ' || l_suppkey || ', ' || l_partkey || CASE l_linenumber % 4 WHEN 0 THEN ' doi:10.1234/ab.' || l_partkey WHEN 1 THEN ' https://doi.org/10.5/x' || l_suppkey WHEN 2 THEN ' arXiv:' || lpad(cast(l_suppkey % 1000 as varchar), 4, '0') || '.' || lpad(cast(l_partkey % 10000 as varchar), 5, '0') || 'v2' ELSE ' astro-ph/' || lpad(cast(l_partkey as varchar), 7, '0') END || CASE l_linenumber % 5 WHEN 0 THEN ' and 2001a' ELSE '' END"
CITED_SQL = f"(SELECT DISTINCT {CITATION} AS c FROM lineitem)"


def _cited(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").select(F.expr(CITATION.replace("varchar", "string")).alias("c")).distinct()


@register(rf"""SELECT c, CASE WHEN len(y) = 1 THEN y[1] WHEN len(y) > 1 THEN nullif(regexp_extract(c, '\(.*([12][09]\d\d).*\)', 1), '') END AS year FROM (SELECT c, list_distinct(regexp_extract_all(c, '\b[12][09]\d\d[a-z]?\b')) AS y FROM {CITED_SQL})""")
def year_extract(spark, d):
    return _cited(spark, d).select("c", X.match_year(F.col("c")).alias("year"))


@register(rf"""SELECT c, coalesce(nullif(regexp_extract(c, '(?i)\bdoi:\s*(10\.[\d.]{{2,9}}/\S+\w)', 1), ''), nullif(regexp_extract(c, '(?i)//(?:dx\.)?doi\.org/(10\.[\d.]{{2,9}}/[^<\s."]*)', 1), ''), nullif(regexp_extract(c, '(?i)\b(10.[\d.]{{2,9}}/\S+\w)', 1), '')) AS doi FROM {CITED_SQL}""")
def doi_extract(spark, d):
    return _cited(spark, d).select("c", X.match_doi(F.col("c")).alias("doi"))


@register(rf"""SELECT c, CASE WHEN regexp_matches(c, 'astro-ph/\d{{7}}\b') THEN regexp_extract(c, '(astro-ph/\d{{7}})\b', 1) WHEN regexp_matches(c, 'arXiv:\d{{4}}\.\d{{4,5}}(v\d+)?\b') THEN regexp_extract(c, 'arXiv:(\d{{4}}\.\d{{4,5}})(v\d+)?\b', 1) END AS arxiv FROM {CITED_SQL}""")
def arxiv_extract(spark, d):
    return _cited(spark, d).select("c", X.match_arxiv_id(F.col("c")).alias("arxiv"))


PAGE = "CASE l_linenumber WHEN 1 THEN 'L' || l_suppkey WHEN 2 THEN l_suppkey || 'S' WHEN 3 THEN 'S' || l_suppkey WHEN 4 THEN 'A' || l_suppkey WHEN 5 THEN 'e' || l_suppkey WHEN 6 THEN '' ELSE l_suppkey || '-' || l_partkey END"


@register(f"SELECT page, CASE WHEN page = '' THEN '' ELSE regexp_extract(page, '(\\d+)', 1) END AS number, CASE WHEN page = '' THEN NULL WHEN page[1] IN ('L', 'A', 'e') THEN page[1] WHEN upper(page[-1]) = 'S' OR upper(page[1]) = 'S' THEN 'S' END AS qualifier, coalesce(CASE WHEN page = '' THEN NULL WHEN page[1] IN ('L', 'A', 'e') THEN page[1] WHEN upper(page[-1]) = 'S' OR upper(page[1]) = 'S' THEN 'S' END, '') || CASE WHEN page = '' THEN '' ELSE regexp_extract(page, '(\\d+)', 1) END AS pages, regexp_extract(page, '(\\d+)', 1) AS volume FROM (SELECT DISTINCT {PAGE} AS page FROM lineitem)")
def page_volume_parse(spark, d):
    rows = _read(spark, d, "lineitem").select(F.expr(PAGE).alias("page")).distinct()
    parsed = X.parse_pages(F.col("page"), letters="e")
    return rows.select("page", parsed["page"].alias("number"), parsed["qualifier"].alias("qualifier"), X.combine_page_qualifier(parsed["page"], parsed["qualifier"]).alias("pages"), X.parse_volume(F.col("page")).alias("volume"))


FIELDS = {
    "a": "CASE WHEN l_linenumber = 7 THEN '' ELSE 'Au' || (l_suppkey % 20) END", "y": "CASE WHEN l_linenumber = 6 THEN NULL ELSE cast(1990 + l_partkey % 30 as varchar) END", "j": "CASE WHEN l_linenumber = 5 THEN '' ELSE 'ApJ' END", "t": "CASE WHEN l_partkey % 3 = 0 THEN 'Title ' || (l_partkey % 8) END",
    "v": "CASE WHEN l_suppkey % 3 > 0 THEN cast(l_suppkey % 40 as varchar) END", "p": "CASE WHEN l_suppkey % 4 = 0 THEN 'L' || (l_partkey % 50) END", "d": "CASE WHEN l_partkey % 5 = 0 THEN '10.1/x' || (l_partkey % 11) END", "e": "CASE WHEN l_partkey % 7 = 0 THEN CASE WHEN l_partkey % 2 = 0 THEN 'arXiv:' ELSE '' END || '1234.' || (l_partkey % 13) END",
}


@register(f"""SELECT refstr, count(*) AS n FROM (SELECT CASE WHEN form IS NOT NULL THEN form || coalesce(' doi:' || d, '') || coalesce(CASE WHEN lower(e) LIKE '%arxiv%' THEN ' ' || e ELSE ' arXiv:' || e END, '') WHEN d IS NOT NULL OR e IS NOT NULL THEN concat_ws(', ', a, y, j, t, v, p, d, e) END AS refstr
FROM (SELECT *, CASE WHEN a IS NULL OR y IS NULL THEN NULL WHEN j IS NOT NULL AND t IS NOT NULL AND (v IS NOT NULL OR p IS NOT NULL) THEN a || ', ' || y || '. ' || j || ', ' || t || tail WHEN j IS NOT NULL AND (v IS NOT NULL OR p IS NOT NULL) THEN a || ', ' || y || '. ' || j || tail WHEN j IS NOT NULL AND (d IS NOT NULL OR e IS NOT NULL) THEN a || ', ' || y || '. ' || j || '.' WHEN t IS NOT NULL THEN a || ', ' || y || '. ' || t || tail WHEN d IS NOT NULL OR e IS NOT NULL THEN a || ', ' || y || '.' END AS form
FROM (SELECT *, coalesce(', ' || v, '') || coalesce(', ' || p, '') || '.' AS tail FROM (SELECT {', '.join(f"nullif({v}, '') AS {k}" for k, v in FIELDS.items())} FROM lineitem)))) GROUP BY refstr""")
def reference_string(spark, d):
    rows = _read(spark, d, "lineitem").select(*(F.expr(v.replace("varchar", "string")).alias(k) for k, v in FIELDS.items()))
    return rows.select(X.reference_string(*(F.col(k) for k in "ayjtvpde")).alias("refstr")).groupBy("refstr").agg(F.count("*").alias("n"))


@register("SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g'), '&amp;', '&', 'g'), '[ \\t\\r\\n]+', ' ', 'g')) AS cleaned FROM pages")
def html_cleanup(spark, d):
    return _read(spark, d, "pages").select("page_id", F.trim(X.rewrite(F.coalesce("html", F.lit("")), [("<[^>]*>", " "), ("&amp;", "&"), (r"[ \t\r\n]+", " ")])).alias("cleaned"))


@register("""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, items[i] AS item FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items FROM pages))""")
def html_items(spark, d):
    return _read(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<li><a href="[^"]*">([^<]*)</a></li>'), F.lit(1))).alias("pos", "item"))


# Ordered operators ---------------------------------------------------------


@register("SELECT conv_id AS history_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS item_num, 'H' || conv_id || 'I' || row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS id, '0000' AS bibcode, -1.0::DOUBLE AS score FROM conversations")
def staged_ids(spark, d):
    blocks = _read(spark, d, "conversations").groupBy(F.col("conv_id").alias("history_id")).agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("l"))
    keyed = blocks.select("history_id", F.transform("l", lambda x: F.struct(F.lit(None).cast("int").alias("item_num"), x["text"].alias("refstr"), F.lit(None).cast("string").alias("refraw"))).alias("references"))
    return store.stage(keyed).select("history_id", "item_num", "id", "bibcode", F.col("score").cast("double").alias("score"))


@register("SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN role || turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS author FROM conversations")
def carry_forward(spark, d):
    rows = _read(spark, d, "conversations").select("conv_id", "turn", F.expr("CASE WHEN turn % 3 = 0 THEN role || turn END").alias("author"))
    return ordered.carry_forward(rows, "author", ["conv_id"], "turn")


@register("""SELECT doc_id, CAST(seg AS BIGINT) AS item_num, string_agg(line, ' ' ORDER BY pos) AS line FROM (SELECT doc_id, pos, line, sum(CASE WHEN regexp_matches(line, '^[A-M]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS seg
FROM (SELECT doc_id, i AS pos, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)))) WHERE seg > 0 GROUP BY ALL""")
def multiline_assembly(spark, d):
    lines = _read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return ordered.assemble(lines, F.col("line").rlike("^[A-M]"), "line", ["doc_id"], "pos")


@register("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 2 = 0 THEN 'new' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def merge_update(spark, d):
    table = _read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    updates = table.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), F.when(F.col("o_orderkey") % 2 == 0, "new").alias("o_orderpriority"))
    return store.merge_rows(table, updates.unionByName(updates.limit(1).withColumn("o_orderkey", F.lit(-1).cast("long"))), ["o_orderkey"])


@register("SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS row_no FROM customer")
def row_numbers(spark, d):
    return store.number_rows(_read(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"]).select("c_custkey", F.col("row_no").cast("long").alias("row_no"))


@register("SELECT p_brand, count(*) AS n FROM (SELECT p_brand FROM part UNION SELECT 'Brand#' || (s_suppkey % 60) FROM supplier) GROUP BY ALL")
def bibcode_union(spark, d):
    both = history.all_bibcodes(_read(spark, d, "part").select(F.col("p_brand").alias("bibcode")), _read(spark, d, "supplier").select(F.expr("'Brand#' || (s_suppkey % 60)").alias("bibcode")))
    return both.groupBy(F.col("bibcode").alias("p_brand")).agg(F.count("*").alias("n"))
