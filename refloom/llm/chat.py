r"""Chat formatting at the level of tokens.

A turn is `### role: text </turn>` and a line feed. Its three marks are reserved ids past the vocabulary; role and text
are encoded separately and spliced between them, so no token crosses a mark. Marks that occur inside a role or text,
and backslashes, get a backslash before them, which reading takes off again. The loss mask is the prefix sum of +1 where
an assistant's text starts and -1 where it ends.

Turns are formatted row by row, without a shuffle. A conversation is then put in order by a sort within its partition
and read as a stream, so what a task holds does not depend on the number of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import vocabulary
from .common import read_table, tokenizer_path
from .simhash import _arrow_type

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
MARKED = r"\\|###|</turn>"
ROLE_MARKED = MARKED + "|:"
LOSS_ROLE = "assistant"


def escape(text: str, marked: str = MARKED) -> str:
    return re.sub(marked, lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(rf"\\({ROLE_MARKED})", r"\1", text)


def reserved(size: int) -> tuple[int, int, int]:
    """The ids of OPEN, MIDDLE and CLOSE for a vocabulary of `size` ids."""
    return size, size + 1, size + 2


def format_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = LOSS_ROLE, path: str | None = None) -> DataFrame:
    """(conv_id, turn, rank, ids array<int>, loss array<boolean>): one row a turn; the conversation is its rows by turn, then rank.

    Null roles and texts count as empty. rank orders rows of one turn number by role and a hash of the text, so ties and
    repeated rows have a defined order. Null conversations are one conversation; null turns come first.
    """
    path = path or tokenizer_path()
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("conv_id", "turn", F.concat("role", F.lit(" "), F.hex(F.xxhash64("text"))).alias("rank"), "role", "text")
    schema = pa.schema([("conv_id", _arrow_type(rows, "conv_id")), ("turn", _arrow_type(rows, "turn")), ("rank", pa.string()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_store import library_encoder

        encoder = library_encoder(path, special=False)
        opens, middles, closes = (np.array([i], np.int32) for i in reserved(vocabulary(path).size))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                role_texts, texts = (part.column(k).to_pylist() for k in (3, 4))
                coded = encoder.texts([escape(r, ROLE_MARKED) for r in role_texts] + [escape(t) for t in texts])
                ids, masks = [], []
                for role, r, t in zip(role_texts, coded, coded[len(texts) :]):
                    ids.append(np.concatenate([opens, r, middles, t, closes]))
                    steps = np.zeros(len(ids[-1]) + 1, np.int8)
                    if role == loss_role:
                        steps[len(r) + 2] += 1
                        steps[len(r) + 2 + len(t)] -= 1
                    masks.append(np.cumsum(steps[:-1]).astype(bool))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(ids, schema.field(3).type), pa.array(masks, schema.field(4).type)], schema=schema)

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn"))
    return rows.mapInArrow(run, f"{kinds}, rank string, ids array<int>, loss array<boolean>")


def digests(turns: DataFrame, path: str | None = None) -> DataFrame:
    """What each conversation says, read back from the ids and masks of format_turns(): counts and digests, by streaming."""
    path = path or tokenizer_path()
    schema = pa.schema([("conv_id", _arrow_type(turns, "conv_id")), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        opens, middles, closes = reserved(vocab.size)
        text_of = lambda ids: vocab.decode(ids).decode("utf-8", "replace")
        state: list | None = None
        done: list[tuple] = []

        def end() -> None:
            if state:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(schema)], schema=schema)
            done.clear()
            return out

        for batch in batches:
            for conv, ids, loss in zip(batch.column("conv_id").to_pylist(), batch.column("ids"), batch.column("loss")):
                if state is None or state[0] != conv:
                    end()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, mask = ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False)
                middle = int(np.flatnonzero(ids == middles)[0])
                if ids[0] != opens or ids[-1] != closes:
                    raise ValueError("a turn without its marks")
                role, text = text_of(ids[1:middle]), text_of(ids[middle + 1 : -1])
                under = unescape(text_of(ids[mask]))
                state[1] += 1
                state[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                state[3] += len(under)
                state[4].update(under.encode())
                state[5] += len(OPEN) + len(role) + len(MIDDLE) + len(text) + len(CLOSE)
            if len(done) >= 1024:
                yield flush()
        end()
        if done:
            yield flush()

    in_order = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "rank")
    return in_order.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = r"\### Assistant: </turn> ok"
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    return digests(format_turns(rows.unionByName(more)))


OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS r,
    replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS t FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(r) + length(t)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
