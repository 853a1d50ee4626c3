"""Language identification by hierarchical discrimination.

A text is the square roots of the counts of its character 1- to 3-grams, hashed, at unit length. Linear support vector
machines first tell language families apart, pair by pair, then one-versus-one machines tell apart the languages of the
family that won. The machines learn from a bounded sample: at most `per_lang` documents of each language, those with
the least hashes. Features of the sample are made on the executors from whole texts; predictions read whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, read_table
from .simhash import _arrow_type

#: ISO 639-1 codes by family; a language that is in none is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk",
    "indic": "hi bn ur pa mr gu ne",
}
UNKNOWN = "und"
DIMENSIONS = 1 << 13
PER_LANG = 400
SAMPLE = 40_000  # documents that are learned from, at most
PIECE = 1 << 20


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and re.search(r"[^\W\d_]", text) is not None and any(c.isalpha() for c in text)


def features(text: str) -> np.ndarray:
    """The unit vector of a whole text; texts without letters: zeros."""
    counts = np.zeros(DIMENSIONS, np.int64)
    lowered = text.lower()
    mix = lambda h: (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)
    for at in range(0, len(lowered), PIECE):
        code = np.frombuffer(lowered[max(0, at - 2) : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.where(_letters()[code], code, 32).astype(np.uint64)
        skip = min(at, 2)  # what the piece before has counted
        two = code[:-1] << np.uint64(21) | code[1:]
        three = two[:-1] << np.uint64(21) | code[2:]
        for order, grams in enumerate((code[skip:], two[max(0, skip - 1) :], three)):
            counts += np.bincount(mix(grams + np.uint64(order + 1)).astype(np.int64), minlength=DIMENSIONS)
    blank = mix(np.array([32 + 1, (32 << 21 | 32) + 2, (32 << 42 | 32 << 21 | 32) + 3], np.uint64)).astype(np.int64)
    counts[blank] = 0
    made = np.sqrt(counts.astype(np.float32))
    norm = float(np.linalg.norm(made))
    return made / norm if norm else made


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear machine with hinge loss (the last is the bias), by dual coordinate descent; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weights, alpha, squares = np.zeros(x.shape[1], np.float32), np.zeros(len(x)), (x * x).sum(axis=1)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)).tolist():
            new = min(cost, max(0.0, alpha[i] - (y[i] * float(x[i] @ weights) - 1) / squares[i]))
            if new != alpha[i]:
                weights += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return weights


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), lang)


class Model:
    """The machines: for each pair of families, and for each pair of languages of one family."""

    def __init__(self, x: np.ndarray, langs: list[str]) -> None:
        names = np.array(langs, object)
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.families.setdefault(family_of(lang), []).append(lang)
        of = np.array([family_of(n) for n in langs], object)
        self.machines: dict[tuple[str, str, str], np.ndarray] = {}
        for a, b in combinations(sorted(self.families), 2):
            self.machines["family", a, b] = self._fit(x, of, a, b)
        for members in self.families.values():
            for a, b in combinations(members, 2):
                self.machines["lang", a, b] = self._fit(x, names, a, b)

    @staticmethod
    def _fit(x: np.ndarray, names: np.ndarray, a: str, b: str) -> np.ndarray:
        rows = (names == a) | (names == b)
        return train_svm(x[rows], np.where(names[rows] == a, 1.0, -1.0))

    def _winner(self, kind: str, names: list[str], margins: dict) -> tuple[str, float]:
        """By votes, then by the sum of margins; its least margin against another, as a probability."""
        won = {n: [0, 0.0, math.inf] for n in names}
        for a, b in combinations(names, 2):
            m = margins[kind, a, b]
            for n, v in ((a, m), (b, -m)):
                won[n] = [won[n][0] + (v > 0), won[n][1] + v, min(won[n][2], v)]
        best = max(names, key=lambda n: (won[n][0], won[n][1], n))
        return best, 1.0 if won[best][2] == math.inf else 1 / (1 + math.exp(-2 * max(-300.0, min(300.0, won[best][2]))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score from 0 to 1) of each text."""
        readable = [has_letter(t) and bool(self.families) for t in texts]
        x = np.stack([features(t) for t, ok in zip(texts, readable) if ok]) if any(readable) else np.zeros((0, DIMENSIONS), np.float32)
        scored = {k: x @ w[:-1] + w[-1] for k, w in self.machines.items()}
        out, row = [], 0
        for ok in readable:
            if not ok:
                out.append((UNKNOWN, 0.0))
                continue
            margins = {k: float(v[row]) for k, v in scored.items()}
            row += 1
            family, p = self._winner("family", sorted(self.families), margins)
            lang, q = self._winner("lang", self.families[family], margins)
            out.append((lang, p * q))
        return out


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text is a multiple of 5 (null id: of the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> Model:
    """Fit the machines on at most per_lang documents of each language, and SAMPLE of all, chosen by hash among those that are not held out.

    Rows without a language or without letters teach nothing. No rows to learn from: a model that knows no language.
    """
    rows = df.where(F.col(lang_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    place = F.pmod(F.xxhash64(F.col("id"), F.col("lang")), F.lit(1 << 30))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # as many as there are languages
    per_lang = max(1, min(per_lang, SAMPLE // max(1, len(counts))))
    if not counts:
        return Model(np.zeros((0, DIMENSIONS), np.float32), [])
    share = F.create_map(*[v for lang, n in counts.items() for v in (F.lit(lang), F.lit(min(1 << 30, math.ceil((per_lang / n) * (1 << 30)))))])
    chosen = rows.withColumn("place", place).where(F.col("place") < F.element_at(share, F.col("lang")))
    schema = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("at", pa.binary()), ("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for text, lang, spot in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    if has_letter(text):
                        made = features(text)
                        where = np.flatnonzero(made)
                        out.append((lang, spot, where.astype("<u2").tobytes(), made[where].astype("<f4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(schema)], schema=schema)

    found = chosen.select("text", "lang", "place").mapInArrow(frugal(run), "lang string, place long, at binary, value binary").collect()
    taken: dict[str, int] = {}
    sample = []
    for r in sorted(found, key=lambda r: (r["lang"], r["place"], bytes(r["at"]), bytes(r["value"]))):
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= per_lang:
            sample.append(r)
    x = np.zeros((len(sample), DIMENSIONS), np.float32)
    for i, r in enumerate(sample):
        x[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["value"], "<f4")
    return Model(x, [r["lang"] for r in sample])


def identify(df: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """df (without its text unless keep_text) with lang_pred and score; null texts and texts without a letter are `und` with score 0, as are all if the model knows no language."""
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    at = df.columns.index(text_col)
    kept = [i for i in range(len(names)) if keep_text or i != at]
    schema = pa.schema([*((names[i], _arrow_type(rows, names[i])) for i in kept), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                told = model.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())], names=schema.names)

    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in (names[i] for i in kept))
    return rows.mapInArrow(frugal(run), f"{kinds}, lang_pred string, score double").toDF(*(df.columns[i] for i in kept), "lang_pred", "score")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, learn(docs), keep_text=False)
