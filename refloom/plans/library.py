"""Registered queries that go through the store, the lookups, the readers of text files, the resolvers and the remaining scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import resolve, routing, store, telemetry, timing
from ..schemas import EVENT, RULE
from ..session import shared_path
from ..sources import files as S
from .registry import CITED_SQL, EVENTS_SQL, NAME_CASE, _cited, _events, _read, _rounded, _stats_sql, register


# Scalars -------------------------------------------------------------------


@register(rf"SELECT c, regexp_replace(b, '\s+', ' ', 'g') || CASE WHEN regexp_matches(b, '\w{{3,}}') AND regexp_matches(b, '\b[12][098]\d\d\w?\b|\d+(st|nd|rd|th)+') THEN '' ELSE ' --- Incomplete' END AS plain FROM (SELECT c, trim(regexp_replace(c, 'http\S+', '', 'g')) AS b FROM {CITED_SQL})")
def plain_text(spark, d):
    return _cited(spark, d).select("c", X.reference_plain_text(F.col("c")).alias("plain"))


@register("SELECT page_id, trim(regexp_replace(html, '<.*?>', ' ', 'g')) AS bare FROM pages")
def tags_stripped(spark, d):
    return _read(spark, d, "pages").select("page_id", X.strip_tags(F.col("html")).alias("bare"))


def _tex_sql() -> str:
    out = r"regexp_replace(t, '\\apj\b', 'ApJ', 'g')"
    for pattern, to in X.LATEX_RULES:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to.replace('$', chr(92))}', 'g')"
    return out


@register(rf"SELECT p_partkey, trim({_tex_sql()}) AS plain FROM (SELECT p_partkey, '{{\bf ' || p_brand || '}} \& \textit{{' || p_name || '}},  ' || p_size || ' \etal \apj \''{{o}} ``x'''' \c c' AS t FROM part)")
def tex_to_text(spark, d):
    text = F.concat(F.lit("{\\bf "), "p_brand", F.lit("} \\& \\textit{"), "p_name", F.lit("},  "), "p_size", F.lit(" \\etal \\apj \\'{o} ``x'' \\c c"))
    return _read(spark, d, "part").select("p_partkey", X.latex_to_text(text, {"\\apj": "ApJ"}).alias("plain"))


@register("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'A, ' || p_brand || ' ' || (1900 + p_size) || ' ApJ ' || p_partkey ELSE 'A, ' || p_brand || ' ApJ ' || p_partkey END AS moved FROM part")
def moved_years(spark, d):
    text = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'A, ' || p_brand || ': ApJ (' || (1900 + p_size) || ') ' || p_partkey ELSE 'A, ' || p_brand || ' ApJ ' || p_partkey END")
    return _read(spark, d, "part").select("p_partkey", X.move_year(text).alias("moved"))


@register(f"SELECT n, replace(n, 'src', 'resolved') || '.result' AS result, split_part(n, '/', 4) AS base, n LIKE '%.iop.xml' AS iop, count(*) AS many FROM (SELECT {NAME_CASE} AS n FROM events) GROUP BY ALL")
def result_names(spark, d):
    name = F.col("n")
    rows = _read(spark, d, "events").select(F.expr(NAME_CASE).alias("n"))
    told = rows.select("n", X.result_filename(F.replace(name, F.lit("src"), F.lit("sources"))).alias("result"), X.basename(name).alias("base"), X.basename(name).rlike(S._glob("*.iop.xml")).alias("iop"))
    return told.groupBy("n", "result", "base", "iop").agg(F.count("*").alias("many"))


@register("SELECT o_orderkey, o_orderstatus IN ('F') AS a, o_orderkey % 4 IN (1, 2) AS b FROM orders")
def truths(spark, d):
    b = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'off' WHEN 1 THEN ' On ' WHEN 2 THEN 'ACTIVE' ELSE '' END")
    return _read(spark, d, "orders").select("o_orderkey", X.as_bool(F.expr("CASE o_orderstatus WHEN 'F' THEN 'yes' ELSE 'no' END")).alias("a"), X.as_bool(b).alias("b"))


@register("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_orderkey END AS history_id, CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS item_num FROM lineitem")
def staged_keys(spark, d):
    rows = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 3, "X1").otherwise(X.staged_id(F.col("l_orderkey"), F.col("l_linenumber"))).alias("id"))
    return rows.select("l_orderkey", "l_linenumber", X.staged_parts(F.col("id")).alias("p")).select("l_orderkey", "l_linenumber", "p.history_id", "p.item_num")


@register(f"SELECT n AS source_filename, split_part(n, '/', 2) AS journal, split_part(n, '/', 3) AS volume, CASE WHEN len(string_split(split_part(n, '/', 4), '.')) > 2 THEN '.' || split_part(n, '.', -2) || '.' || split_part(n, '.', -1) ELSE '.' || split_part(n, '.', -1) END AS extension FROM (SELECT DISTINCT {NAME_CASE} AS n FROM events)")
def path_parts(spark, d):
    return routing.path_parts(_read(spark, d, "events").select(F.expr(NAME_CASE).alias("source_filename")).distinct())


# Text files and lookups ----------------------------------------------------


@register("SELECT 'b' || l_orderkey AS source_bibcode, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS pos, CAST(l_linenumber % 7 AS VARCHAR) AS score, lpad(CAST(l_partkey AS VARCHAR), 19, '.') AS bibcode, 'ref ' || l_suppkey AS reference FROM lineitem")
def classic_lines(spark, d):
    line = F.expr("(l_linenumber % 7) || ' ' || lpad(cast(l_partkey AS string), 19, '.') || '   ref ' || l_suppkey || ' '")
    rows = _read(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("line")).alias("s"))
    texts = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("s")).alias("l"))
    text = F.concat(F.lit("---<b"), "l_orderkey", F.lit(">---\n"), F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n"))
    return S.classic_results(texts.select(F.col("l_orderkey").alias("path"), text.alias("text")))


@register("SELECT 'f' || (l_orderkey % 20) AS path, 's' || (l_suppkey % 50) AS source_bibcode, string_agg(CASE l_linenumber % 4 WHEN 1 THEN 'c' || l_partkey || ';t' ELSE 'c' || l_partkey END, '|' ORDER BY l_orderkey * 10 + l_linenumber, CASE l_linenumber % 4 WHEN 1 THEN 'c' || l_partkey || ';t' ELSE 'c' || l_partkey END) AS refs FROM lineitem WHERE l_linenumber % 4 <> 3 GROUP BY ALL")
def pair_lines(spark, d):
    line = F.expr("CASE l_linenumber % 4 WHEN 0 THEN 's' || (l_suppkey % 50) || ';c' || l_partkey WHEN 1 THEN 's' || (l_suppkey % 50) || '; c' || l_partkey || ';t' WHEN 2 THEN 'c' || l_partkey || '\t' || 's' || (l_suppkey % 50) ELSE '#s' || l_suppkey || ';c' END")
    lines = _read(spark, d, "lineitem").select(F.expr("'f' || (l_orderkey % 20)").alias("path"), F.expr("l_orderkey * 10 + l_linenumber").alias("pos"), line.alias("line"))
    return S.pairs(lines).select("path", "source_bibcode", F.array_join("references", "|").alias("refs"))


@register("SELECT lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':10:20 ' || o_orderkey || '.raw with ' || o_custkey || ' references' AS line FROM orders WHERE o_orderkey % 3 > 0")
def progress_log(spark, d):
    message = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'Source file none' ELSE 'Source file /a/' || o_orderkey || '.raw with ' || o_custkey || ' references, processed successfully.' END").alias("message")
    clock = F.expr("'2024-01-01T' || lpad(cast(o_orderkey % 24 AS string), 2, '0') || ':10:20Z'").alias("timestamp")
    return S.progress_lines(_read(spark, d, "orders").select(F.to_json(F.struct(message, clock)).alias("value")))


@register("SELECT '\\m' || p_size AS macro, arg_max(p_name, p_partkey) AS meaning FROM part GROUP BY p_size")
def macro_lookup(spark, d):
    return S.macro_table(_read(spark, d, "part").select(F.col("p_partkey").alias("pos"), F.concat(F.lit("\\m"), "p_size", F.lit(" \t"), "p_name", F.lit(" ")).alias("line")))


@register("SELECT 'e' || (p_size % 9) AS entity, arg_max(p_brand, p_partkey) AS ascii FROM part WHERE p_partkey % 5 > 0 GROUP BY 1 UNION ALL SELECT '#' || p_size, arg_min(p_brand, p_partkey) FROM part WHERE p_partkey % 5 > 0 AND p_partkey % 2 = 0 GROUP BY 1")
def entity_lookup(spark, d):
    line = F.expr("""CASE p_partkey % 5 WHEN 0 THEN '"' || p_size || '" "e"' ELSE '"' || p_size || '"\t"e' || (p_size % 9) || '" "' || p_brand || '"  "$x$"' || CASE p_partkey % 2 WHEN 0 THEN ' P' ELSE '' END END""")
    return S.entity_table(_read(spark, d, "part").select(F.col("p_partkey").alias("pos"), line.alias("line")))


@register("SELECT 'lr-' || p_size AS code, arg_max(p_name, p_partkey) AS bibcode FROM part WHERE p_partkey % 4 > 0 GROUP BY 1")
def code_lookup(spark, d):
    line = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'bad' ELSE p_name || '\t10.1/x/lr-' || p_size || ' ' END")
    return S.code_table(_read(spark, d, "part").select(F.col("p_partkey").alias("pos"), line.alias("line")))


# Telemetry -----------------------------------------------------------------


@register(f"SELECT event_type AS name, {_stats_sql('value')} FROM events WHERE event_id % 3 > 0 GROUP BY 1")
def app_timing(spark, d):
    extra = F.struct(*((F.col("event_type") if f.name == "name" else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT["extra"].dataType))
    rows = _read(spark, d, "events").select(F.lit(0.0).alias("ts"), F.expr("CASE event_id % 3 WHEN 0 THEN 'file_wall' ELSE 'app_timing' END").alias("stage"), F.col("value").alias("duration_ms"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("record_id"), extra.alias("extra"))
    return _rounded(telemetry.named_timing(telemetry.prepare(rows), "app_timing"))


@register(f"SELECT source_filename AS \"group\", round(quantile_cont(CASE WHEN stage = 'record_wall' THEN duration_ms END, 0.95), 6) AS wall_p95 FROM {EVENTS_SQL} GROUP BY 1")
def groups_by_wall(spark, d):
    return _rounded(telemetry.slowest(telemetry.breakdown(_events(spark, d), "source_filename"), None).select("group", "wall_p95"))


@register("SELECT round(greatest(1.0, avg(l_quantity)), 6) AS factor FROM lineitem")
def load_adjustment(spark, d):
    return _rounded(telemetry.load_factor(_read(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("normalized_load_1m"))))


def _ingest_sql() -> str:
    p = "(SELECT 'a/J/1/f' || (o_custkey % 40) || '.raw' AS f, o_orderkey % 11 = 0 AS bad, o_custkey % 40 AS ms, o_custkey, o_orderkey FROM orders)"
    share = lambda ms: f"round(sum(n) * {ms}::DOUBLE / (SELECT count(*) FILTER (NOT bad) FROM p), 4)"
    block = "(SELECT f, o_custkey, count(*) AS n FROM p WHERE NOT bad GROUP BY ALL)"
    file = "(SELECT f, max(ms) AS ms, count(*) FILTER (NOT bad) AS n FROM p GROUP BY f)"
    item = "(SELECT 1 AS n FROM p WHERE NOT bad)"
    rows = [
        f"SELECT 'parser_lookup' AS stage, count(*) AS events, CAST(count(*) AS BIGINT) AS records, round(8.0::DOUBLE, 4) AS ms, count(DISTINCT f) AS files FROM {file}",
        f"SELECT 'parse_dispatch', count(*), CAST(sum(n) AS BIGINT), round(sum(ms), 4), count(DISTINCT f) FROM {file}",
        f"SELECT 'file_wall', count(*), CAST(sum(n) AS BIGINT), round(8.0::DOUBLE + sum(ms) + 700.0::DOUBLE, 4), count(DISTINCT f) FROM {file}",
        "SELECT 'record_error', count(*), NULL, NULL, count(DISTINCT f) FROM p WHERE bad",
        f"SELECT 'pre_resolved_db', count(*), CAST(sum(n) AS BIGINT), {share(100)}, count(DISTINCT f) FROM {block}",
        f"SELECT 'ingest_enqueue', count(*), CAST(sum(n) AS BIGINT), NULL, count(DISTINCT f) FROM {block}",
        f"SELECT 'queue_references', count(*), CAST(sum(n) AS BIGINT), {share(600)}, count(DISTINCT f) FROM {block}",
        *(f"SELECT '{s}', count(*), CAST(count(*) AS BIGINT), {share(ms)}, (SELECT count(DISTINCT f) FROM p WHERE NOT bad) FROM {item}" for s, ms in (("record_wall", 600), ("resolver_http", 400), ("post_resolved_db", 200))),
    ]
    return f"WITH p AS {p} " + " UNION ALL ".join(rows)


@register(_ingest_sql())
def ingest_events(spark, d):
    name = F.expr("'a/J/1/f' || (o_custkey % 40) || '.raw'").alias("source_filename")
    rows = _read(spark, d, "orders").select(name, F.lit("P").alias("parser_name"), F.expr("CASE o_orderkey % 11 WHEN 0 THEN 'bad' END").alias("error"), F.expr("cast(o_custkey % 40 AS double)").alias("parse_ms"), F.expr("'b' || o_custkey").alias("source_bibcode"), X.staged_id(F.col("o_orderkey"), F.lit(1)).alias("id"))
    good = rows.where("error is null")
    blocks = good.groupBy("source_filename", "source_bibcode", "parser_name").agg(F.count("*").alias("n"))
    made = timing.ingest_events(rows, blocks, good, {"lookup": 8.0, "load": 100.0, "resolve": 400.0, "update": 200.0}, 0.0)
    told = made.groupBy("stage").agg(F.count("*").alias("events"), F.sum("extra.record_count").alias("records"), F.sum("duration_ms").alias("ms"), F.count_distinct("extra.source_filename").alias("files"))
    return told.withColumn("ms", F.round("ms", 4))


# Store and resolvers -------------------------------------------------------


@register("SELECT c_custkey AS bibcode, 'f' || (c_custkey % 7) AS source_filename, CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE 'new' END AS parser_name FROM customer")
def sources_inserted(spark, d):
    rows = _read(spark, d, "customer").select(F.col("c_custkey").alias("bibcode"), F.expr("'f' || (c_custkey % 7)").alias("source_filename"), F.lit("new").alias("parser_name"))
    return store.insert_absent(rows.where("bibcode % 2 = 0").withColumn("parser_name", F.lit("old")), rows.unionByName(rows), ["bibcode", "source_filename"])


LIFECYCLE_SQL = """WITH refs AS (SELECT o_orderkey, o_custkey, 'part' || (l_partkey % 200) AS refstr, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey) AS item_num FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
runs AS (SELECT o_orderkey, row_number() OVER (ORDER BY 'b' || o_custkey, 'f' || o_orderkey) AS history_id, n FROM (SELECT o_orderkey, o_custkey, count(*) AS n FROM refs GROUP BY ALL))
SELECT history_id, CAST(item_num AS INTEGER) AS item_num, refstr AS reference_str, CASE WHEN p_partkey IS NULL THEN '...................' ELSE 'B' || p_partkey END AS bibcode, CASE WHEN p_partkey IS NULL THEN 0.0::DOUBLE ELSE 0.75::DOUBLE END AS score, CAST(n AS INTEGER) AS total_ref, 'initial' AS status
FROM refs JOIN runs USING (o_orderkey) LEFT JOIN part ON refstr = 'part' || p_partkey AND p_partkey < 100"""


@register(LIFECYCLE_SQL)
def store_lifecycle(spark, d):
    """Sources, runs and items of all orders, loaded in one transaction, resolved and read back."""
    st = store.Store(spark, shared_path(spark, "store"))
    lines = _read(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", F.expr("'part' || (l_partkey % 200)").alias("refstr")).alias("s"))
    refs = F.transform(F.array_sort(F.collect_list("s")), lambda x: F.struct(F.lit(None).cast("int").alias("item_num"), x["refstr"].alias("refstr"), x["refstr"].alias("refraw")))
    blocks = lines.groupBy("l_orderkey").agg(refs.alias("references"))
    parsed = _read(spark, d, "orders").join(blocks, F.col("o_orderkey") == F.col("l_orderkey")).select(F.expr("'b' || o_custkey").alias("source_bibcode"), F.expr("'f' || o_orderkey").alias("source_filename"), F.lit("r").alias("resolved_filename"), F.lit("P").alias("parser_name"), F.col("o_orderdate").cast("timestamp").alias("source_modified"), F.col("o_orderdate").cast("timestamp").alias("date"), "references")
    staged = st.load(parsed, "initial")
    known = _read(spark, d, "part").where("p_partkey < 100").select(F.expr("'part' || p_partkey").alias("refstr"), F.expr("'B' || p_partkey").alias("bibcode"), F.lit(0.75).alias("score"))
    st.resolve(resolve.answers(resolve.table_resolver(known)(staged.select("id", F.col("reference_str").alias("refstr")))))
    runs = st.read("processed_history").select(F.col("id").alias("history_id"), "total_ref", "status")
    return st.read("resolved_reference").join(runs, "history_id").select("history_id", "item_num", "reference_str", "bibcode", F.col("score").cast("double").alias("score"), "total_ref", "status")


@register("SELECT c_custkey AS history_id, 1 AS item_num, '2000mock........A' AS bibcode, 1.0::DOUBLE AS score, CASE WHEN c_custkey % 3 = 0 THEN 'raw' ELSE c_name END AS reference_str, 'mock:H' || c_custkey || 'I1' AS external FROM customer")
def mock_answers(spark, d):
    refs = _read(spark, d, "customer").select(X.staged_id(F.col("c_custkey"), F.lit(1)).alias("id"), F.expr("CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END").alias("refstr"), F.lit("raw").alias("refraw"))
    return resolve.answers(resolve.mock_resolver(refs)).select("history_id", "item_num", "bibcode", F.col("score").cast("double").alias("score"), "reference_str", F.array_join("external_identifier", ",").alias("external"))


@register("""SELECT 'H' || c_custkey || 'I1' AS id, '{"reference":["' || c_name || '"],"id":["H' || c_custkey || 'I1"]}' AS body FROM customer""")
def request_bodies(spark, d):
    return resolve.request(_read(spark, d, "customer").select(X.staged_id(F.col("c_custkey"), F.lit(1)).alias("id"), F.col("c_name").alias("refstr")))


@register("SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NOT NULL THEN p_name END AS doi_bibcode, CASE WHEN s_suppkey IS NOT NULL THEN 's' || l_suppkey ELSE '' END AS verified_bibcode FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 2 = 0 LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 3 = 0")
def doi_lookup(spark, d):
    rows = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.expr("'10.1/' || l_partkey").alias("doi"), F.expr("'s' || l_suppkey").alias("bibcode"))
    table = _read(spark, d, "part").where("p_partkey % 2 = 0").select(F.expr("'10.1/' || p_partkey").alias("doi"), F.col("p_name").alias("bibcode"))
    known = _read(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.expr("'s' || s_suppkey").alias("bibcode"))
    return resolve.verified(resolve.doi_bibcodes(rows, table), known).select("l_orderkey", "l_linenumber", "doi_bibcode", "verified_bibcode")


@register("SELECT n, j AS journal, CAST(count(*) AS BIGINT) AS rules FROM (SELECT 'p' || (p_size % 10) AS n, p_brand AS j FROM part WHERE NOT (p_size % 10 = 3 AND p_brand = 'Brand#11') UNION ALL SELECT 'p4', 'NEW' WHERE EXISTS (SELECT 1 FROM part WHERE p_size % 10 = 4)) GROUP BY ALL")
def rule_edits(spark, d):
    null = lambda t, c: F.lit(None).cast(t).alias(c)
    rule = lambda journal: F.struct(journal.alias("journal"), null("boolean", "all_volume"), null("int", "volume_begin"), null("int", "volume_end"), null("int", "volume_number"), null("string", "partial_bibcode"), null("string", "volume_string")).cast(RULE)
    parsers = _read(spark, d, "part").groupBy(F.expr("'p' || (p_size % 10)").alias("name")).agg(F.collect_list(rule(F.col("p_brand"))).alias("matches"))
    edited = store.add_rules(store.drop_rule_journal(parsers, "p3", "Brand#11"), "p4", F.array(rule(F.lit("NEW"))))
    return edited.select(F.col("name").alias("n"), F.explode("matches").alias("m")).groupBy("n", F.col("m.journal").alias("journal")).agg(F.count("*").alias("rules"))
