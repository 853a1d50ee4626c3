"""Scans of source files, classic results, pairs files, telemetry logs and lookup files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import basename, nonempty
from ..schemas import EVENT, RULE

#: Names that are never candidates.
EXCLUDED = ("*.result", "*.pyc", ".DS_Store")


def _glob(pattern: str) -> str:
    """A file-name glob as a regular expression over the whole name."""
    special = {"*": ".*", "?": "."}
    return "^" + "".join(special.get(c, "\\" + c if not c.isalnum() else c) for c in pattern) + "$"


def _path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def binary_files(spark: SparkSession, paths: list[str] | str, recursive: bool = False) -> DataFrame:
    """(path, modificationTime, length, content) of files; content is read only if it is used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(paths)


def discover(spark: SparkSession, root: str, pattern: str = "*", since=None) -> DataFrame:
    """(group, paths): the files below root whose name fits the glob and that were changed at `since` or later, by their
    first directory below root (empty: root itself), groups and paths in order."""
    files = binary_files(spark, root, recursive=True).select("path", "modificationTime").where(basename(F.col("path")).rlike(_glob(pattern)))
    if since is not None:
        files = files.where(F.col("modificationTime") >= F.lit(since))
    below = F.regexp_extract("path", r"^(?:file:/*)?/?" + "\\Q" + root.rstrip("/").removeprefix("file:").lstrip("/") + "\\E/(.*)$", 1)
    group = F.when(below.contains("/"), F.split_part(below, F.lit("/"), F.lit(1))).otherwise("")
    return files.groupBy(group.alias("group")).agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("group")


def candidates(spark: SparkSession, path: str, patterns: list[str], limit: int | None = None) -> DataFrame:
    """Different paths whose name fits any of the globs, in order, without results and leftovers. limit: the first so many."""
    name = basename(F.col("path"))
    files = binary_files(spark, path, recursive=True).select("path")
    fits = reduce(lambda a, b: a | b, (name.rlike(_glob(p)) for p in patterns))
    found = files.where(fits & ~reduce(lambda a, b: a | b, (name.rlike(_glob(p)) for p in EXCLUDED))).distinct().orderBy("path")
    return found.limit(limit) if limit else found


def without_processed(files: DataFrame, spark: SparkSession, list_path: str, column: str = "group") -> DataFrame:
    """files whose column is in no line of a skip list; no list, nothing to skip."""
    if not _path_exists(spark, list_path):
        return files
    skip = spark.read.text(list_path).select(F.trim("value").alias(column)).where(F.col(column) != "")
    return files.join(skip, column, "left_anti")


def classic_results(files: DataFrame) -> DataFrame:
    """(source_bibcode, pos, score, bibcode, reference) of classic result files given as (path, text): blocks that start with ---<bibcode>---."""
    blocks = files.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?s)(---<[^>\n]*>---\r?\n(?:(?!---<)[^\n]*\n?)*)"), F.lit(1))).alias("block"))
    lines = blocks.select(F.regexp_extract("block", r"^---<([^>]*)>", 1).alias("source_bibcode"), F.posexplode(F.slice(F.split("block", r"\r?\n"), 2, 1 << 30)).alias("pos", "line")).where("line <> ''")
    return lines.select("source_bibcode", "pos", F.substring("line", 1, 1).alias("score"), F.substring("line", 3, 19).alias("bibcode"), F.trim(F.substring("line", 25, 1 << 30)).alias("reference"))


def pairs(lines: DataFrame) -> DataFrame:
    """(path, source_bibcode, references) of pairs files given as (path, pos, line): `source;cited[;text]`, or cited, tab,
    source. Comments (#) and lines without either are left out; references keep the order of their lines."""
    clean = lines.where(~F.col("line").startswith("#") & (F.trim("line") != ""))
    semi = F.split("line", ";", 3)
    tab = F.split("line", "\t")
    made = clean.select(
        "path", "pos",
        F.when(F.col("line").contains(";"), F.trim(semi[0])).when(F.col("line").contains("\t"), F.trim(tab[1])).alias("source_bibcode"),
        F.when(F.col("line").contains(";"), F.concat_ws(";", F.trim(semi[1]), nonempty(F.trim(F.try_element_at(semi, F.lit(3)))))).when(F.col("line").contains("\t"), F.trim(tab[0])).alias("refstr"),
    ).where("source_bibcode is not null")
    grouped = made.groupBy("path", "source_bibcode").agg(F.sort_array(F.collect_list(F.struct("pos", "refstr"))).alias("l"))
    return grouped.select("path", "source_bibcode", F.transform("l", lambda x: x["refstr"]).alias("references"))


def events(spark: SparkSession, path: str, run_id: str | None = None, context_id: str | None = None) -> DataFrame:
    """Telemetry events of a JSON-lines log; lines that are no JSON objects are skipped, a missing log is empty."""
    if not path or not _path_exists(spark, path):
        return spark.createDataFrame([], EVENT)
    found = spark.read.schema(EVENT).option("mode", "DROPMALFORMED").json(path)
    for column, value in (("run_id", run_id), ("context_id", context_id)):
        if value is not None:
            found = found.where(F.col(column) == str(value))
    return found


def progress_lines(logs: DataFrame) -> DataFrame:
    """(line) `HH:MM:SS name with N references` from structured log lines (value) that tell of a processed source file."""
    told = logs.select(F.from_json("value", "message string, timestamp string, asctime string").alias("j"))
    pattern = r"^Source file (.+) with (\d+) references, processed successfully\.$"
    clock = F.regexp_extract(F.coalesce("j.timestamp", "j.asctime"), r"(\d{2}:\d{2}:\d{2})", 1)
    return told.where(F.col("j.message").rlike(pattern)).select(F.concat(clock, F.lit(" "), basename(F.regexp_extract("j.message", pattern, 1)), F.lit(" with "), F.regexp_extract("j.message", pattern, 2), F.lit(" references")).alias("line"))


def numbered_lines(files: DataFrame) -> DataFrame:
    """(path, pos, line) of files given as (path, text)."""
    return files.select("path", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line"))


def texts(files: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """(path, text) of binary files; bytes outside the encoding are replaced."""
    return files.select("path", F.decode("content", encoding).alias("text"))


def macro_table(lines: DataFrame) -> DataFrame:
    """(macro, meaning) of lines `macro meaning` (pos, line): split at the first white space, the last of one macro counts."""
    split = lines.select("pos", F.split(F.trim("line"), r"\s+", 2).alias("p")).where(F.size("p") == 2)
    last = Window.partitionBy("macro").orderBy(F.desc("pos"))
    return split.select("pos", F.col("p")[0].alias("macro"), F.col("p")[1].alias("meaning")).withColumn("n", F.row_number().over(last)).where("n = 1").select("macro", "meaning")


def entity_table(lines: DataFrame) -> DataFrame:
    """(entity, ascii) of lines (pos, line) of an entity file: fields between white space, with or without quotes: code, name, ASCII, TeX, kind.

    Lines of fewer than four fields, or whose code is no number, are left out. The last line of a name counts; `#code` stands
    for the first line of that code that tells its kind.
    """
    fields = F.transform(F.split(F.trim("line"), r"\s+"), lambda f: F.regexp_replace(f, r'^"(.*)"$|^"$', "$1"))
    told = lines.select("pos", fields.alias("f")).where(F.size("f") > 3)
    told = told.select("pos", F.regexp_extract(F.col("f")[0], r"^(\d+)(?:[:;].*)?$", 1).alias("code"), F.col("f")[1].alias("entity"), F.col("f")[2].alias("ascii"), (F.size("f") > 4).alias("kind")).where("code <> ''")
    names = told.groupBy("entity").agg(F.max_by("ascii", "pos").alias("ascii"))
    codes = told.where("kind").groupBy(F.concat(F.lit("#"), "code").alias("entity")).agg(F.min_by("ascii", "pos").alias("ascii"))
    return names.unionByName(codes)


def code_table(lines: DataFrame) -> DataFrame:
    """(code, bibcode) of lines (pos, line) `bibcode, tab, DOI`: the code is the last part of the DOI, the last line of a code counts; other lines are left out."""
    fields = lines.select("pos", F.split("line", "\t").alias("f")).where(F.size("f") == 2)
    told = fields.select("pos", F.element_at(F.split(F.trim(F.col("f")[1]), "/"), -1).alias("code"), F.trim(F.col("f")[0]).alias("bibcode"))
    return told.groupBy("code").agg(F.max_by("bibcode", "pos").alias("bibcode"))


def parser_table(spark: SparkSession, path: str) -> DataFrame:
    """The parser table from JSON lines."""
    return spark.read.schema(f"name string, extension_pattern string, reference_service_endpoint string, matches array<{RULE}>").json(path)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A table of a database; with a key and its bounds, read in so many ranges at a time."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    return reader.load()
