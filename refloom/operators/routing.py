"""Which parser reads a source file: by its extension, else by extension, journal and volume rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import basename, file_extension, nonempty


def unique_extension_parsers(parsers: DataFrame) -> DataFrame:
    """Parsers that are the only one of their extension; matches is then an array of one array."""
    found = parsers.groupBy("extension_pattern").agg(F.min("name").alias("name"), F.min("reference_service_endpoint").alias("reference_service_endpoint"), F.collect_list("matches").alias("matches"), F.count("extension_pattern").alias("n"))
    return found.where("n = 1").drop("n")


def has_journal(matches, journal) -> F.Column:
    return F.exists(matches, lambda m: m["journal"] == journal)


def path_parts(files: DataFrame, column: str = "source_filename") -> DataFrame:
    """files with journal, volume and extension; paths of fewer than three parts have none."""
    parts = F.split(F.col(column), "/")
    take = lambda k: nonempty(F.try_element_at(parts, F.lit(k)))
    return files.withColumns({"journal": take(-3), "volume": take(-2), "extension": F.when(take(-3).isNotNull() & take(-2).isNotNull(), file_extension(basename(F.col(column))))})


def rule_table(parsers: DataFrame) -> DataFrame:
    """One row for each rule of each parser, in order."""
    return parsers.select("name", "extension_pattern", "reference_service_endpoint", F.posexplode("matches").alias("rule_no", "rule")).select("name", "extension_pattern", "reference_service_endpoint", "rule_no", "rule.*")


def route(files: DataFrame, parsers: DataFrame, column: str = "source_filename") -> DataFrame:
    """files with parser_name and endpoint, null where no parser fits.

    A parser that alone has the extension takes the file. Else those of the extension that name the journal are
    candidates, or, if there is none and the extension has two parts, those of its last part. One candidate takes the
    file whatever its rules say; among several the first rule that holds decides, by parser name and rule order: all
    volumes, an equal string, a number in a range or an equal number.
    """
    keyed = path_parts(files, column)
    kind = ["journal", "volume", "extension"]  # files of one kind have one parser
    unique = unique_extension_parsers(parsers).select(F.col("extension_pattern").alias("extension"), F.col("name").alias("u_name"), F.col("reference_service_endpoint").alias("u_end"))
    rules = rule_table(parsers).withColumnRenamed("journal", "rule_journal")
    one = F.concat(F.lit("."), F.element_at(F.split("extension", r"\."), -1))
    turns = F.array_distinct(F.array(F.struct(F.lit(0).alias("turn"), F.col("extension").alias("ext")), F.struct(F.lit(1).alias("turn"), one.alias("ext"))))
    tried = keyed.select(*kind).distinct().select(*kind, F.explode(turns).alias("try")).select(*kind, "try.*")
    found = tried.join(rules, (tried["ext"] == rules["extension_pattern"]) & (tried["journal"] == rules["rule_journal"]))
    by_kind = Window.partitionBy(*kind)
    found = found.withColumn("_turn", F.min("turn").over(by_kind)).where("turn = _turn")
    found = found.withColumn("_names", F.size(F.collect_set("name").over(by_kind)))
    number = F.when(F.col("volume").rlike(r"^\d+$"), F.col("volume").cast("int"))
    fits = F.coalesce(F.col("all_volume"), F.lit(False)) | (F.coalesce(F.col("partial_bibcode"), F.lit("")) == F.col("volume")) | F.coalesce(F.col("volume_string") == F.col("volume"), F.lit(False))
    fits = fits | F.coalesce(number.between(F.coalesce("volume_begin", F.lit(9999)), F.coalesce("volume_end", F.lit(0))), F.lit(False)) | F.coalesce(number == F.col("volume_number"), F.lit(False))
    first = F.min_by(F.struct("name", "reference_service_endpoint"), F.struct("name", "rule_no"))
    chosen = found.where((F.col("_names") == 1) | fits).groupBy(*kind).agg(first.alias("m"))
    out = keyed.join(unique, "extension", "left").join(chosen, kind, "left")
    return out.select(*files.columns, *kind, F.coalesce("u_name", "m.name").alias("parser_name"), F.coalesce("u_end", "m.reference_service_endpoint").alias("endpoint"))
