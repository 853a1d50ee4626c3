"""The citation store: Parquet tables under one folder, changed by transactions.

Every append and every rewrite goes to a new folder. A commit lists, for each table, the folders that make it up; readers go by
the last commit, so they see all of a transaction or nothing of it, and what a failed one has written is never looked at.
Tables have one writer.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.expressions import nonempty, staged_id
from ..schemas import QUEUED_BIBCODE, QUEUED_SCORE, TABLES
from ..session import shared_path


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._open: dict[str, list[str]] | None = None

    def _last(self) -> tuple[int, dict[str, list[str]]]:
        """The number of the last commit, and the folders of each table."""
        with contextlib.suppress(AnalysisException):
            found = self.spark.read.schema("name string, folders array<string>, n int").json(f"{self.root}/commits")
            rows = found.where(F.col("n") == found.agg(F.max("n")).first()[0]).collect()  # one a table
            if rows:
                return rows[0].n, {r.name: list(r.folders) for r in rows}
        return -1, {}

    @contextlib.contextmanager
    def transaction(self) -> Iterator[Store]:
        """What is written inside becomes visible to others at the end, all at once; after an error, nothing does. Inner ones are part of the outer."""
        if self._open is not None:
            yield self
            return
        n, self._open = self._last()
        try:
            yield self
            made = self.spark.createDataFrame(sorted(self._open.items()), "name string, folders array<string>")
            made.coalesce(1).write.json(f"{self.root}/commits/n={n + 1}")
        finally:
            self._open = None

    def _folders(self, table: str) -> list[str]:
        return (self._last()[1] if self._open is None else self._open).get(table, [])

    def read(self, table: str) -> DataFrame:
        """The table; columns that older files lack are null. Inside a transaction, with what it has written."""
        paths = [f"{self.root}/{f}" for f in self._folders(table)]
        return self.spark.read.schema(TABLES[table]).parquet(*paths) if paths else self.spark.createDataFrame([], TABLES[table])

    def _write(self, table: str, rows: DataFrame, kept: list[str]) -> str:
        folder = f"{table}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        with self.transaction():
            self._open[table] = [*kept, folder]
        return f"{self.root}/{folder}"

    def append(self, table: str, rows: DataFrame) -> str:
        """Adds rows; columns that they lack are null. Returns where they are."""
        schema = TABLES[table]
        shaped = self.spark.createDataFrame([], schema).unionByName(rows, allowMissingColumns=True).select([F.col(f.name).cast(f.dataType) for f in schema])
        return self._write(table, shaped, self._folders(table))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Makes rows the table; its many folders become one."""
        self._write(table, rows, [])

    def written(self, df: DataFrame, what: str = "rows") -> DataFrame:
        """df, written once beside the tables and read from there as often as it is used."""
        path = f"{self.root}/staging/{what}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def add_sources(self, sources: DataFrame) -> None:
        """Those that are not there yet."""
        new = sources.dropDuplicates(["bibcode", "source_filename"]).join(self.read("reference_source"), ["bibcode", "source_filename"], "left_anti")
        self.append("reference_source", new)

    def add_runs(self, runs: DataFrame, order: list[str] = ["bibcode", "source_filename"]) -> DataFrame:  # noqa: B006
        """Append history rows; returns them with their ids, which go on from the largest, in the given order.

        Runs are ranked within ranges of their order and the ranges' sizes added up, so no task numbers all of them.
        """
        top = self.read("processed_history").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        numbered = number_rows(runs, order, path=f"{self.root}/staging/runs-{uuid.uuid4().hex}").withColumn("id", F.col("row_no") + F.lit(top)).drop("row_no")
        self.append("processed_history", numbered)
        return numbered

    def merge(self, table: str, updates: DataFrame, keys: list[str]) -> None:
        """Rows of the table with their values from updates where the key is the same; keys that are not there are not added."""
        self.replace(table, merge_rows(self.read(table), updates, keys))

    def load(self, parsed: DataFrame, status: str) -> DataFrame:
        """Stage parsed references as a new run of each source, sources, runs and items in one transaction; returns the items
        with id `H..I..` for the resolver, source_filename and source_bibcode.

        parsed: source_bibcode, source_filename, resolved_filename, parser_name, source_modified, date, references array of
        struct(item_num, refstr, refraw); it is evaluated once. status "initial" adds sources and keeps item numbers, "retry" numbers items anew.
        """
        parsed = self.written(parsed, "parsed")
        with self.transaction():
            if status == "initial":
                self.add_sources(parsed.select(F.col("source_bibcode").alias("bibcode"), "source_filename", "resolved_filename", "parser_name"))
            runs = self.add_runs(parsed.select(F.col("source_bibcode").alias("bibcode"), "source_filename", "source_modified", "date", F.lit(status).alias("status"), F.size("references").alias("total_ref")))
            runs = runs.select(F.col("bibcode").alias("source_bibcode"), "source_filename", F.col("id").alias("history_id"))
            keyed = parsed.join(runs, ["source_bibcode", "source_filename"])
            path = self.append("resolved_reference", stage(keyed, keep_numbers=status == "initial").drop("id"))
        items = self.spark.read.schema(TABLES["resolved_reference"]).parquet(path)
        return items.withColumn("id", staged_id(F.col("history_id"), F.col("item_num"))).join(runs, "history_id")

    def resolve(self, answers: DataFrame, classic: DataFrame | None = None) -> None:
        """Write the resolver's answers over the staged rows, and the comparison with classic results if there are any."""
        with self.transaction():
            self.merge("resolved_reference", answers, ["history_id", "item_num"])
            if classic is not None:
                self.append("compare_classic", classic)

    def orphans(self) -> dict[str, int]:
        """Rows that refer to nothing, by table; all 0 in a sound store."""
        t = {n: self.read(n) for n in TABLES}
        runs = t["processed_history"].select(F.col("id").alias("history_id"))
        return {
            "processed_history": t["processed_history"].join(t["reference_source"], ["bibcode", "source_filename"], "left_anti").count(),
            "resolved_reference": t["resolved_reference"].join(runs, "history_id", "left_anti").count(),
            "compare_classic": t["compare_classic"].join(t["resolved_reference"], ["history_id", "item_num"], "left_anti").count(),
        }


def number_rows(df: DataFrame, order: list[str], name: str = "row_no", path: str | None = None) -> DataFrame:
    """df with 1, 2, ... in the given order, by range partitions: only their sizes are added up in one task.

    The bounds of ranges come from a sample and may be others each time that a plan runs, so rows are written once (to path,
    else to the shared folder) with their range and their place in it, and numbered from there.
    """
    path = path or shared_path(df.sparkSession, "ranges")
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    parts = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("_at", LongType())])).parquet(path).withColumn("_part", F.shiftright("_at", 33))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_skip", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_skip")
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return parts.join(F.broadcast(sizes), "_part").withColumn(name, row + F.col("_skip")).drop("_part", "_at", "_skip")


def stage(keyed: DataFrame, keep_numbers: bool = True) -> DataFrame:
    """References of runs (history_id, references) as queued rows, with the id that the resolver gets."""
    rows = keyed.select("history_id", F.posexplode("references").alias("pos", "r"))
    number = F.coalesce(F.col("r.item_num"), F.col("pos") + 1) if keep_numbers else F.col("pos") + 1
    made = rows.select("history_id", number.cast("int").alias("item_num"), F.coalesce(F.col("r.refstr"), F.lit("")).alias("reference_str"), F.lit(QUEUED_BIBCODE).alias("bibcode"), F.lit(QUEUED_SCORE).cast("decimal(10,4)").alias("score"), F.col("r.refraw").alias("reference_raw"))
    return made.withColumn("id", staged_id(F.col("history_id"), F.col("item_num")))


def merge_rows(table: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """table with the values of updates where the key is the same; nulls in updates leave the old value."""
    values = [c for c in updates.columns if c not in keys and c in table.columns]
    new = updates.dropDuplicates(keys).select(*keys, *(F.col(v).alias(f"_new_{v}") for v in values))
    joined = table.join(new, keys, "left")
    pick = lambda c: F.coalesce(F.col(f"_new_{c}").cast(table.schema[c].dataType), F.col(c)).alias(c) if c in values else F.col(c)
    return joined.select(*(pick(c) for c in table.columns))


def present(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the table has."""
    return rows.join(table.select(*keys), keys, "left_semi")


def absent(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the table lacks; a key with a null is in no table."""
    return rows.join(table.select(*keys), keys, "left_anti")


def insert_absent(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """table and those rows whose key it lacks."""
    return table.unionByName(absent(rows.dropDuplicates(keys), table, keys), allowMissingColumns=True)


def drop_rule_journal(parsers: DataFrame, parser: str, journal: str) -> DataFrame:
    """parsers with the rules of one journal taken from one parser."""
    rest = F.filter("matches", lambda m: m["journal"] != journal)
    return parsers.withColumn("matches", F.when(F.col("name") == parser, rest).otherwise(F.col("matches")))


def add_rules(parsers: DataFrame, parser: str, rules: Column) -> DataFrame:
    """parsers with rules (an array) added to one parser."""
    return parsers.withColumn("matches", F.when(F.col("name") == parser, F.concat("matches", rules)).otherwise(F.col("matches")))


def reference_json(df: DataFrame) -> DataFrame:
    """Rows as JSON without empty fields."""
    kept = [nonempty(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name) for f in df.schema]
    return df.select(F.to_json(F.struct(*kept)).alias("json"))
