"""Resolvers: what turns staged references into bibcodes. Pluggable; a mock, a table and an HTTP service."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import nonempty, staged_parts
from ..schemas import UNRESOLVED

#: The mock's answer.
MOCK_BIBCODE, MOCK_SCORE = "2000mock........A", 1.0
RESPONSE = "id string, refstring string, bibcode string, scix_id string, score double, external_identifier array<string>, publication_year int, refereed_status int"

Resolver = Callable[[DataFrame], DataFrame]


def request(refs: DataFrame, kind: str = "text") -> DataFrame:
    """(id, body): the JSON that the service gets for each reference, as text or as parsed fields."""
    if kind == "text":
        body = F.to_json(F.struct(F.array("refstr").alias("reference"), F.array("id").alias("id")))
    else:
        body = F.to_json(F.struct(F.array(F.struct(*(c for c in refs.columns))).alias("parsed_reference")))
    return refs.select("id", body.alias("body"))


def mock_resolver(refs: DataFrame) -> DataFrame:
    """The same bibcode for all; the reference is the first of refstr, refplaintext and refraw that is not empty."""
    texts = [nonempty(F.col(c)) for c in ("refstr", "refplaintext", "refraw") if c in refs.columns]
    return refs.select("id", F.coalesce(*texts, F.lit("")).alias("refstring"), F.lit(MOCK_BIBCODE).alias("bibcode"), F.lit(None).cast("string").alias("scix_id"), F.lit(MOCK_SCORE).alias("score"), F.array(F.concat(F.lit("mock:"), "id")).alias("external_identifier"), F.lit(None).cast("int").alias("publication_year"), F.lit(None).cast("int").alias("refereed_status"))


def table_resolver(known: DataFrame) -> Resolver:
    """Looks references up in (refstr, bibcode, score); what is not there is unresolved with score 0."""

    def resolve(refs: DataFrame) -> DataFrame:
        table = known.select(F.col("refstr").alias("_ref"), F.col("bibcode").alias("_bib"), F.col("score").cast("double").alias("_score")).dropDuplicates(["_ref"])
        hit = refs.join(table, F.col("refstr") == F.col("_ref"), "left")
        return hit.select("id", F.col("refstr").alias("refstring"), F.coalesce("_bib", F.lit(UNRESOLVED)).alias("bibcode"), F.lit(None).cast("string").alias("scix_id"), F.coalesce("_score", F.lit(0.0)).alias("score"), F.lit(None).cast("array<string>").alias("external_identifier"), F.lit(None).cast("int").alias("publication_year"), F.lit(None).cast("int").alias("refereed_status"))

    return resolve


def http_resolver(url: str, token: str = "", per_request: int = 1, retries: int = 3, timeout: float = 60.0) -> Resolver:
    """Posts references to a service, some at a time; what fails after the retries has no answer and stays queued."""

    def resolve(refs: DataFrame) -> DataFrame:
        def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import urllib.request

            for pdf in batches:
                for at in range(0, len(pdf), per_request):
                    part = pdf.iloc[at : at + per_request]
                    body = json.dumps({"reference": part["refstr"].tolist(), "id": part["id"].tolist()}).encode()
                    post = urllib.request.Request(url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {token}"})
                    for _ in range(retries):
                        try:
                            with urllib.request.urlopen(post, timeout=timeout) as reply:
                                rows = json.load(reply)["resolved"] if reply.status == 200 else []
                        except (OSError, ValueError, KeyError):
                            continue
                        fields = [f.split(" ")[0] for f in RESPONSE.split(", ")]
                        yield pd.DataFrame([{f: r.get(f) for f in fields} for r in rows], columns=fields)
                        break

        return refs.select("id", "refstr").mapInPandas(call, RESPONSE)

    return resolve


def answers(responses: DataFrame) -> DataFrame:
    """Responses as updates of resolved references: keys from the id, the text as the resolver saw it."""
    key = staged_parts(F.col("id"))
    return responses.select(key["history_id"].alias("history_id"), key["item_num"].alias("item_num"), F.col("refstring").alias("reference_str"), "bibcode", F.col("score").cast("decimal(10,4)").alias("score"), F.col("refstring").alias("reference_raw"), "external_identifier", "scix_id", "publication_year", "refereed_status")


def doi_bibcodes(rows: DataFrame, table: DataFrame, doi: str = "doi") -> DataFrame:
    """rows with the bibcode of their DOI from (doi, bibcode), null if there is none."""
    lookup = table.select(F.col("doi").alias("_doi"), F.col("bibcode").alias("doi_bibcode")).dropDuplicates(["_doi"])
    return rows.join(lookup, F.col(doi) == F.col("_doi"), "left").drop("_doi")


def verified(rows: DataFrame, known: DataFrame, column: str = "bibcode") -> DataFrame:
    """rows with verified_bibcode: the bibcode if it is known, else empty."""
    lookup = known.select(F.col("bibcode").alias("_known")).distinct()
    return rows.join(lookup, F.col(column) == F.col("_known"), "left").withColumn("verified_bibcode", F.coalesce("_known", F.lit(""))).drop("_known")
