"""Table and record schemas, enumerations and sentinels of the citation store."""

from __future__ import annotations

from pyspark.sql import types as T

UNRESOLVED = "." * 19  # the resolver found nothing
QUEUED_BIBCODE, QUEUED_SCORE = "0000", -1  # staged, not resolved yet
ACTIONS = ("initial", "retry", "delete")
STATES = ("MATCH", "MISS", "NEW", "NEWU", "DIFF")
HIDDEN_STATES = ("UNVER", "NONE")

SCORE = T.DecimalType(10, 4)


_ATOMS = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "decimal(10,4)": SCORE}


def _fields(text: str) -> list[str]:
    """The parts between the commas that are not inside brackets."""
    parts, depth = [""], 0
    for c in text:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return [p.strip() for p in parts]


def _type(text: str) -> T.DataType:
    if text.startswith("array<"):
        return T.ArrayType(_type(text[6:-1]))
    if text.startswith("struct<"):
        return T.StructType([T.StructField(n, _type(t)) for n, t in (f.split(":", 1) for f in _fields(text[7:-1]))])
    return _ATOMS[text]


def _struct(text: str) -> T.StructType:
    """A schema from `name type, ...`, without a session."""
    return T.StructType([T.StructField(n, _type(t)) for n, t in (f.split(" ", 1) for f in _fields(text))])


RULE = "struct<journal:string,all_volume:boolean,volume_begin:int,volume_end:int,volume_number:int,partial_bibcode:string,volume_string:string>"
PARSER = _struct(f"name string, extension_pattern string, reference_service_endpoint string, matches array<{RULE}>")
ACTION = _struct("status string")
REFERENCE_SOURCE = _struct("bibcode string, source_filename string, resolved_filename string, parser_name string")
PROCESSED_HISTORY = _struct("id bigint, bibcode string, source_filename string, source_modified timestamp, status string, date timestamp, total_ref int")
RESOLVED_REFERENCE = _struct("history_id bigint, item_num int, reference_str string, bibcode string, score decimal(10,4), reference_raw string, external_identifier array<string>, scix_id string, publication_year int, refereed_status int")
COMPARE_CLASSIC = _struct("history_id bigint, item_num int, bibcode string, score decimal(10,4), state string")
TABLES = {"action": ACTION, "parser": PARSER, "reference_source": REFERENCE_SOURCE, "processed_history": PROCESSED_HISTORY, "resolved_reference": RESOLVED_REFERENCE, "compare_classic": COMPARE_CLASSIC}

#: Fields of a parsed reference, in order.
REFERENCE_FIELDS = ("authors", "journal", "title", "volume", "issue", "page", "year", "doi", "arxiv", "refstr", "issn", "refplaintext", "series", "bibcode")
PARSED_REFERENCE = _struct("source_filename string, source_bibcode string, pos int, item_num int, refraw string, " + ", ".join(f"{f} string" for f in REFERENCE_FIELDS))
RESOLVER_RESPONSE = "struct<id:string,refstring:string,bibcode:string,scix_id:string,score:double,external_identifier:array<string>,publication_year:int,refereed_status:int>"
EVENT = _struct(
    "ts double, stage string, run_id string, context_id string, record_id string, duration_ms double, status string, "
    "extra struct<source_filename:string,parser_name:string,source_bibcode:string,input_extension:string,source_type:string,raw_subfamily:string,run_mode:string,name:string,error:string,error_type:string,record_count:int>"
)
SYSTEM_METRICS = tuple([f"{p}_{m}m" for p in ("loadavg", "normalized_load") for m in (1, 5, 15)] + ["memory_total_bytes", "memory_available_bytes", "memory_used_bytes", "memory_available_ratio", "memory_used_ratio"])
SYSTEM_SAMPLE = _struct("ts double, platform string, memory_probe string, cpu_count int, " + ", ".join(f"{m} double" for m in SYSTEM_METRICS))
