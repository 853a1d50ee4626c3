"""Registered queries that parse files made of a table's values, so that SQL knows what must come out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import ordered, store
from ..parse import parse_blocks, parse_files
from .registry import _read, register

#: A reference of each dialect: {a} author, {y} year, {j} journal, {v} volume, {p} page.
TEMPLATES = {
    "CrossRef": "<citation key='1'><author>{a}</author><journal_title>{j}</journal_title><volume>{v}</volume><first_page>{p}</first_page><cYear>{y}</cYear></citation>",
    "JATS": "<mixed-citation publication-type='journal'><name><surname>{a}</surname></name><source>{j}</source><year>{y}</year><volume>{v}</volume><fpage>{p}</fpage></mixed-citation>",
    "NLM": "<ref><nlm-citation citation-type='journal'><person-group person-group-type='author'><name><surname>{a}</surname></name></person-group><source>{j}</source><year>{y}</year><volume>{v}</volume><fpage>{p}</fpage></nlm-citation></ref>",
    "IOP": "<reference><ref_authors>{a}</ref_authors><ref_year>{y}</ref_year><ref_journal>{j}</ref_journal><ref_volume>{v}</ref_volume><ref_start_page>{p}</ref_start_page></reference>",
    "IOPFT": "<ref><name><surname>{a}</surname></name><year>{y}</year><source>{j}</source><volume>{v}</volume><fpage>{p}</fpage></ref>",
    "APS": "<ref><refauth>{a}</refauth><jtitle>{j}</jtitle><volume>{v}</volume><pages>{p}</pages><date>{y}</date></ref>",
    "AIP": "<ref><biaugrp><biauth><bilname>{a}</bilname></biauth></biaugrp><journal>{j}</journal><vol>{v}</vol><pp>{p}</pp><year>{y}</year></ref>",
    "SPRINGER": "<Citation><BibArticle><BibAuthorName><FamilyName>{a}</FamilyName></BibAuthorName><Year>{y}</Year><JournalTitle>{j}</JournalTitle><VolumeID>{v}</VolumeID><FirstPage>{p}</FirstPage></BibArticle></Citation>",
    "ELSEVIER": "<reference><contribution><authors><author><surname>{a}</surname></author></authors></contribution><host><maintitle>{j}</maintitle><volume-nr>{v}</volume-nr></host><date>{y}</date><first-page>{p}</first-page></reference>",
    "WILEY": "<citation type='journal'><author><familyName>{a}</familyName></author><pubYear>{y}</pubYear><journalTitle>{j}</journalTitle><vol>{v}</vol><pageFirst>{p}</pageFirst></citation>",
    "BLACKWELL": "<reference type='journal'><name><surname>{a}</surname></name><date date='{y}'/><title type='journal'>{j}</title><volume>{v}</volume><page_first>{p}</page_first></reference>",
    "AGU": "<citation><first_author>{a}</first_author><journal_title>{j}</journal_title><firstPage>{p}</firstPage><volume>{v}</volume><year>{y}</year></citation>",
    "NATURE": "<reftxt><refau><snm>{a}</snm></refau> <jtl>{j}</jtl> <vid>{v}</vid>, {p} (<cd year='{y}'>{y}</cd>)</reftxt>",
    "ICARUS": "<CITATION><AUTHOR TYPE='x'><SURNAME>{a}</SURNAME></AUTHOR><DATE>{y}</DATE><SERTITLE>{j}</SERTITLE><VID>{v}</VID><FPAGE>{p}</FPAGE></CITATION>",
    "RSC": "<citgroup><journalcit><citauth><surname>{a}</surname></citauth><title>{j}</title><year>{y}</year><volumeno>{v}</volumeno><fpage>{p}</fpage></journalcit></citgroup>",
    "JSTAGE": "<Citation><Original lang='en'>x</Original><CitAuthor>{a}</CitAuthor><CitJournalName>{j}</CitJournalName><CitYear>{y}</CitYear><CitVol>{v}</CitVol><CitFirstPage>{p}</CitFirstPage></Citation>",
    "AnA": "<bibliomixed><bibliomisc id='1|2|{j}|{a}|{v}|1|{p}|{y}'/></bibliomixed>",
    "EDP": "<bibliomixed><bibliomisc id='1|2|{j}|{a}|{v}|1|{p}|{y}'/></bibliomixed>",
    "MDPI": "<ref><name><surname>{a}</surname></name><year>{y}a</year><source>{j}</source><volume>Vol {v}</volume><fpage>{p}</fpage></ref>",
    "OUP": "<ref><name><surname>{a}</surname></name><year>{y}</year><source>{j}</source><volume>{v}</volume><fpage>{p}</fpage></ref>",
    "OUPFT": "<ref><mixed-citation publication-type='journal'><name><surname>{a}</surname></name><year>{y}</year><source>{j}</source><comment>{v} {p}</comment></mixed-citation></ref>",
    "UCP": "<ref><name><surname>{a}</surname></name><year>{y}</year><series>{j}</series><volume>{v}</volume><fpage>{p}</fpage></ref>",
    "SPIE": "<ref><mixed-citation publication-type='journal'><name><surname>{a}</surname></name><source>{j}</source><year>{y}</year><volume>{v}</volume><fpage>{p}</fpage></mixed-citation></ref>",
    "VERSITA": "<ref><element-citation><name><surname>{a}</surname></name><source>{j}</source><year>{y}</year><volume>{v}</volume><fpage>{p}</fpage></element-citation></ref>",
    "PASA": "<ref><authorgroup><sname>{a}</sname></authorgroup><year>{y}</year><jtitle>{j}</jtitle><volume>{v}</volume><fp>{p}</fp></ref>",
    "CUP": "<citation citation-type='journal'><name><surname>{a}</surname></name><year>{y}</year><source>{j}</source><volume>{v}</volume><fpage>{p}</fpage></citation>",
    "LivingReviews": "<record><author>{a}</author><year>{y}</year><journal>{j}</journal><volume>{v}</volume><pages>{p}</pages></record>",
}
PLAIN_TEMPLATES = {"AAS": "<CITATION>{a} {y}, {j} {v} {p}</CITATION>", "EGU": "<reference>{a} {y}, {j} {v} {p}</reference>", "IPAP": "<BibUnstructured>{a}: {j} ({y}) {v} {p}</BibUnstructured>", "ONCP": "<bibtext>{a} <I>{y}</I>, {j} {v} {p}</bibtext>"}
#: Files of the text formats: each holds one reference, whose text is TEXT.
TEXT_FILES = {
    "ADStxt": "%R {b}\n%Z\n{t}\n", "arXiv": "%R {b}\n%Z\n[1] {t}\n", "FlatTXT": "no citation here\n{t}\n", "ARAnATXT": "% a comment\n1. {t}\n", "PThPhTXT": "%R {b}\n%Z\n1 {t}\n", "ThreeBibsTxt": "{t}\n", "PairsTXT": "# a comment\n{b};{t}\n",
    "ADSocr": "{t}\n", "ObsOCR": "(1O) {t}\n", "ADStex": "%R {b}\n%Z\n\\bibitem{{x}} {t}\n", "ADSHTML": "<UL><LI>{t}</UL>", "AnAhtml": "<UL><LI>{t}</UL>", "AnAShtml": "<LI>{t}<LI>", "JLVEnHTML": "<TR><TD valign=\"top\">{t}</TD></TR>",
    "PASPhtml": "<ADSBIBCODE>{b}</ADSBIBCODE><CITATION ID='1'>{t}</CITATION>", "PASJhtml": "<ADSBIBCODE>{b}</ADSBIBCODE><FONT SIZE=2>{t}</FONT>", "AREPSHTML": "<TD>{t}</TD>", "AnnRevHTML": "(doi:10.1146/{k}) <nobr>{t} <script>x</script>", "AnRFMhtml": "(doi:10.1146/{k}) <nobr>{t} <script>x</script>", "ARAnAhtml": "(doi:10.1146/{k}) <nobr>{t} <script>x</script>",
    "AEdRvHTML": "<p class=\"author\">by <strong>A Zed</strong> Issue 1, Volume 7:{k}-999, {y}<p class=\"reference\">{t}</p>",
}
FIELDS = {"a": "concat('Author', s_suppkey)", "y": "cast(1980 + s_suppkey % 40 as string)", "j": "concat('Journ', s_suppkey % 7)", "v": "cast(10 + s_suppkey % 80 as string)", "p": "cast(100 + s_suppkey as string)", "k": "cast(s_suppkey as string)", "b": "concat('2000Test.', lpad(cast(s_suppkey as string), 9, '.'), 'X')"}
TEXT = "{a}, X. {y}, Icarus, {v}, {p}"
SQL_FIELDS = {k: v.replace("concat(", "concat(").replace("string)", "varchar)") for k, v in FIELDS.items()}


def _filled(template: str) -> Column:
    out = F.lit(template.replace("{t}", TEXT).replace("{{", "{").replace("}}", "}"))
    for k, v in FIELDS.items():
        out = F.replace(out, F.lit("{%s}" % k), F.expr(v))
    return out


def _spread(rows: DataFrame) -> DataFrame:
    """rows in as many tasks as there are cores, or more: parsing takes far longer than reading them, and a number asked for is not coalesced."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _files(suppliers: DataFrame, templates: dict[str, str], header: str = "") -> DataFrame:
    """A file for each supplier and parser; suppliers, of which one small file has many, go to all cores first."""
    made = F.array(*(F.struct(F.lit(n).alias("parser_name"), _filled(header + t).alias("text")) for n, t in templates.items()))
    flat = _spread(suppliers.select("s_suppkey")).select("s_suppkey", F.expr(FIELDS["b"]).alias("b"), F.explode(made).alias("f"))
    path = F.concat(F.lit("/sources/J/"), F.col("s_suppkey"), F.lit("/"), F.col("b"), F.lit(".ref.txt"))
    return flat.select("s_suppkey", path.alias("path"), F.col("f.parser_name").alias("parser_name"), F.col("f.text").cast("binary").alias("content"))


def _named(spark, files: DataFrame, lookup: dict[str, str] | None = None) -> DataFrame:
    """What the parsers make of files, with their names: one pass over all parsers together, told apart by path."""
    marked = files.withColumn("path", F.concat(F.col("path"), F.lit("?"), F.col("parser_name")))
    return parse_files(marked, lookup).select(F.split_part("source_filename", F.lit("?"), F.lit(2)).alias("parser_name"), F.split_part("source_filename", F.lit("/"), F.lit(4)).cast("long").alias("s_suppkey"), F.coalesce("refstr", "refplaintext").alias("refstr"), "error")


_values = lambda names: ", ".join(f"('{n}')" for n in names)


@register(f"SELECT name AS parser_name, s_suppkey, {SQL_FIELDS['a']} || ', ' || {SQL_FIELDS['y']} || '. ' || {SQL_FIELDS['j']} || ', ' || {SQL_FIELDS['v']} || ', ' || {SQL_FIELDS['p']} || '.' AS refstr FROM supplier, (VALUES {_values(TEMPLATES)}) t(name)")
def xml_dialects(spark, d):
    rows = _named(spark, _files(_read(spark, d, "supplier"), {n: "<ADSBIBCODE>{b}</ADSBIBCODE>" + t for n, t in TEMPLATES.items() if n != "LivingReviews"}))
    living = _spread(_read(spark, d, "supplier").select("s_suppkey")).select("s_suppkey", F.concat(F.lit("/sources/J/"), F.col("s_suppkey"), F.lit("/code.living.xml")).alias("path"), F.lit("LivingReviews").alias("parser_name"), _filled(TEMPLATES["LivingReviews"]).cast("binary").alias("content"))
    named = parse_files(living, {"code": "1998LRR.....1....3R"}).select(F.lit("LivingReviews").alias("parser_name"), F.split_part("source_filename", F.lit("/"), F.lit(4)).cast("long").alias("s_suppkey"), F.coalesce("refstr", "refplaintext").alias("refstr"), "error")
    return rows.unionByName(named).where("error is null").drop("error")


@register(f"SELECT name AS parser_name, s_suppkey, {SQL_FIELDS['a']} || ' ' || {SQL_FIELDS['y']} || CASE name WHEN 'IPAP' THEN ' ' ELSE ', ' END || {SQL_FIELDS['j']} || ' ' || {SQL_FIELDS['v']} || ' ' || {SQL_FIELDS['p']} AS refstr FROM supplier, (VALUES {_values(PLAIN_TEMPLATES)}) t(name)")
def xml_plain_dialects(spark, d):
    return _named(spark, _files(_read(spark, d, "supplier"), {n: "<ADSBIBCODE>{b}</ADSBIBCODE>" + t for n, t in PLAIN_TEMPLATES.items()})).where("error is null").drop("error")


@register(f"SELECT name AS parser_name, s_suppkey, {SQL_FIELDS['a']} || ', X. ' || {SQL_FIELDS['y']} || ', Icarus, ' || {SQL_FIELDS['v']} || ', ' || {SQL_FIELDS['p']} AS refstr FROM supplier, (VALUES {_values(TEXT_FILES)}) t(name)")
def text_formats(spark, d):
    suppliers = _read(spark, d, "supplier")
    dois = {r.doi: r.b for r in suppliers.select(F.expr("concat('10.1146/', s_suppkey)").alias("doi"), F.expr(FIELDS["b"]).alias("b")).collect()}  # the lookup is a service's table
    return _named(spark, _files(suppliers, TEXT_FILES), dois).where("error is null").drop("error")


@register(f"SELECT s_suppkey, 5 AS item_num, {SQL_FIELDS['a']} || ', X. ' || {SQL_FIELDS['y']} || ', Icarus, ' || {SQL_FIELDS['v']} || ', ' || {SQL_FIELDS['p']} AS refstr FROM supplier")
def buffered_blocks(spark, d):
    """Batches as reprocessing makes them, through a parser."""
    ref = F.struct(F.lit(5).alias("item_num"), F.lit(None).cast("string").alias("refstr"), _filled("[1] {t}").alias("refraw"))
    block = F.struct(F.expr(FIELDS["b"]).alias("source_bibcode"), F.array(ref).alias("references"))
    rows = _read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("source_filename"), F.lit("arXiv").alias("parser_name"), F.array(block).alias("block_references"))
    return parse_blocks(rows).where("error is null").select(F.col("source_filename").cast("long").alias("s_suppkey"), "item_num", "refstr")


@register("SELECT o_orderkey, k, repeat('M', k // 1000) || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][k // 100 % 10 + 1] || ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][k // 10 % 10 + 1] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][k % 10 + 1] AS roman, CAST(k AS INTEGER) AS back FROM (SELECT o_orderkey, o_orderkey % 3999 + 1 AS k FROM orders)")
def roman_numerals(spark, d):
    rows = _read(spark, d, "orders").select("o_orderkey", F.expr("o_orderkey % 3999 + 1").alias("k"))
    return rows.withColumn("roman", X.int_to_roman(F.col("k"))).withColumn("back", X.roman_to_int(F.col("roman")))


@register("SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS content, regexp_replace(html, '<title>(.*?)</title>', '') AS rest FROM pages WHERE regexp_matches(html, '<title>(.*?)</title>') UNION ALL SELECT page_id, NULL, coalesce(html, '') FROM pages WHERE NOT coalesce(regexp_matches(html, '<title>(.*?)</title>'), false)")
def tag_extract(spark, d):
    found = X.extract_tag(F.col("html"), "title")
    return _read(spark, d, "pages").select("page_id", found["content"].alias("content"), found["rest"].alias("rest"))


@register("SELECT o_orderkey, strftime(o_orderdate, '%Y') || 'AEdRv' || lpad(CAST(o_custkey % 100 AS VARCHAR), 4, '.') || 'a' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '.') || o_orderstatus AS bibcode FROM orders")
def journal_bibcodes(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", X.journal_bibcode(F.date_format("o_orderdate", "yyyy"), "AEdRv", F.expr("cast(o_custkey % 100 as string)"), F.expr("cast(o_orderkey % 1000 as string)"), F.col("o_orderstatus"), F.lit("a")).alias("bibcode"))


@register("SELECT c_custkey, '{\"c_custkey\":' || c_custkey || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',\"segment\":\"' || c_mktsegment || '\"' ELSE '' END || '}' AS json FROM customer")
def reference_json(spark, d):
    rows = _read(spark, d, "customer").select("c_custkey", F.expr("CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE '' END").alias("segment"))
    return store.reference_json(rows).select(F.get_json_object("json", "$.c_custkey").cast("long").alias("c_custkey"), "json")


@register("SELECT p_partkey, list_aggregate(t[2:], 'string_agg', ' ') AS rest FROM (SELECT p_partkey, string_split('a b a c d', ' ') AS t FROM part)")
def bag_difference(spark, d):
    tokens = F.array(*map(F.lit, "abacd"))
    return _read(spark, d, "part").select("p_partkey", F.array_join(ordered.bag_difference(tokens, F.array(F.lit("a"), F.lit("z"))), " ").alias("rest"))


@register("SELECT s_suppkey, 'H' || s_suppkey || 'I' || (s_suppkey % 9) AS id, s_suppkey AS history_id, CAST(s_suppkey % 9 AS INTEGER) AS item_num FROM supplier")
def staged_id_parts(spark, d):
    rows = _read(spark, d, "supplier").select("s_suppkey", X.staged_id(F.col("s_suppkey"), F.expr("s_suppkey % 9")).alias("id"))
    return rows.select("s_suppkey", "id", X.staged_parts(F.col("id"))["history_id"].alias("history_id"), X.staged_parts(F.col("id"))["item_num"].alias("item_num"))
