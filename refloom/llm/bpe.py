"""Byte-level BPE encoding and decoding by a pair occurrence index.

Texts are cut into words by the vocabulary's pattern; each different word of a partition is encoded once. All new words
lie in one array of symbols, and an index maps each pair that the vocabulary merges, by its rank, to all positions
where it occurs. The active ranks are taken in ascending order; a merge is applied to all positions of its pair at once,
and the pairs it makes with their neighbours are added to the lists of their ranks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import REMEMBERED, frugal, read_table, tokenizer_path
from .simhash import _arrow_type

#: Fixed value: how the vocabularies of this family cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = 6 << 20  # characters that are encoded at a time
WORDS = 600_000  # different words that a worker remembers
AT_ONCE = 1 << 18  # pairs that are looked up at a time


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: itself if it is printable, else the next from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file says: merges, bytes of each id, and strings that are one token of their own."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocab = told["model"]["vocab"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        texts = [b""] * self.size
        for token, i in vocab.items():
            texts[i] = bytes(of_letter[c] for c in token) if all(c in of_letter for c in token) else token.encode()
        for token, i in self.special.items():
            texts[i] = token.encode()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        keys = left * self.size + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.left, self.right, self.made = left, right, np.array([vocab[a + b] for a, b in pairs], np.int64)
        lengths = np.array([len(t) for t in texts])
        self.token_bytes, self.token_starts, self.token_lengths = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it does not merge."""
        want = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == want), self.order[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and the number of each word's."""
        lengths = np.array([len(w) for w in words], np.int64)
        n = int(lengths.sum()) + len(words)
        sym = np.full(n + 1, -1, np.int32)  # each word ends with -1
        starts = np.cumsum(lengths + 1) - lengths - 1
        inside = np.ones(n, bool)
        inside[starts + lengths] = False
        sym[:n][inside] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        before[0] = after[n] = n
        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(positions: np.ndarray) -> None:
            rank = self.ranks(sym[positions], sym[after[positions]])
            hit = rank >= 0
            positions, rank = positions[hit], rank[hit]
            if not len(rank):
                return
            by = np.argsort(rank, kind="stable")
            rank, positions = rank[by], positions[by]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.r_[0, cuts]].tolist(), np.split(positions, cuts)):
                if r in lists:
                    lists[r].append(part)
                else:
                    lists[r] = [part]
                    heapq.heappush(heap, r)

        for at in range(0, n - 1, AT_ONCE):
            add(np.arange(at, min(at + AT_ONCE, n - 1), dtype=np.int32))
        while heap:
            r = heapq.heappop(heap)
            parts = lists.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            a, b = self.left[r], self.right[r]
            at = at[sym[at] == a]
            at = at[sym[after[at]] == b]
            if a == b and len(at) > 1:  # in a run of one symbol, pairs are taken from the left
                taken, last = [], -1
                for p, q in zip(at.tolist(), after[at].tolist()):
                    if p != last:
                        taken.append(p)
                        last = q
                at = np.array(taken, np.int32)
            if not len(at):
                continue
            gone = after[at]
            sym[at] = self.made[r]
            sym[gone] = -2
            later = after[gone]
            after[at] = later
            before[later] = at
            add(np.union1d(at, before[at]) if len(at) > 1 else np.array([before[at[0]], at[0]]))
        live = sym[:n] >= 0
        counts = np.add.reduceat(live, starts) if len(words) else np.zeros(0, np.int64)
        return sym[:n][live].astype(np.int32), counts

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        return self.token_bytes[spread(self.token_starts[ids], self.token_lengths[ids])].tobytes()


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i] + 1, ..., for lengths[i] each, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


LETTER, NUMBER, OTHER, SPACE = range(4)
PIECE = 1 << 20  # characters that are cut into words at a time


@lru_cache(1)
def _latin_classes() -> np.ndarray:
    """Class of each Latin-1 character."""
    kinds = [regex.compile(k) for k in (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]", r"\s")]
    return np.array([next(k for k, r in enumerate(kinds) if r.match(chr(c))) for c in range(256)], np.uint8)


def latin_words(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the words of PATTERN start in Latin-1 texts one after another; texts: where each (none empty) starts."""
    kind = _latin_classes()[data]
    new = np.r_[True, kind[1:] != kind[:-1]]
    first = np.zeros(len(data) + 1, bool)
    first[texts] = first[-1] = True
    new |= first[:-1]
    run = np.flatnonzero(new)
    end = np.r_[run[1:], len(data)]
    mark = np.zeros(len(data) + 1, bool)
    space = kind[run] == SPACE
    # a run that is not white space takes one blank before it
    word = run[~space]
    blank = ~first[word] & (data[word - 1] == 32)
    mark[word - blank] = True
    # white space before a word leaves it its last character
    low, high = run[space], end[space]
    followed = ~first[high]
    mark[low[~followed | (high - low > 1) | (data[low] != 32)]] = True
    mark[high[followed & (data[high - 1] != 32)] - 1] = True
    # an apostrophe alone before certain letters takes them
    lone = word[~blank & (data[word] == 39) & (end[~space] - word == 1)]
    lone = lone[~first[lone + 1]]
    after, then = data[lone + 1], np.where(first[np.minimum(lone + 2, len(data))], 0, data[np.minimum(lone + 2, len(data) - 1)])
    takes = np.where(np.isin(after, np.frombuffer(b"stmd", np.uint8)), 1, 0)
    for pair in (b"re", b"ve", b"ll"):
        takes[(after == pair[0]) & (then == pair[1])] = 2
    lone, takes = lone[takes > 0], takes[takes > 0]
    mark[lone + 1] = False
    rest = lone + 1 + takes
    mark[rest[~new[np.minimum(rest, len(data) - 1)] & (rest < len(data))]] = True
    return np.flatnonzero(mark[:-1])


SHORT = 15  # bytes of a word that two 64-bit numbers hold, with its length
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_keys(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word of at most SHORT bytes as two 64-bit numbers: its bytes, and its length in the last."""
    padded = data + bytes(16)
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    low, high = eight[starts] & _MASKS[np.minimum(lengths, 8)], eight[starts + 8] & _MASKS[np.clip(lengths - 8, 0, 7)]
    return low, high | lengths.astype(np.uint64) << np.uint64(56)


class WordIndex:
    """Numbers for words of word_keys(), looked up all at once and compared whole: open addressing in arrays."""

    def __init__(self, bits: int = 16) -> None:
        self.used = 0
        self.factors = np.frombuffer(os.urandom(16), np.uint64) | np.uint64(1)
        self._clear(1 << bits)

    def _clear(self, size: int) -> None:
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.low, self.high, self.numbers = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ low >> np.uint64(32)) * self.factors[0] + (high ^ high >> np.uint64(32)) * self.factors[1]
        return ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return slot + np.uint64(1) & np.uint64(len(self.low) - 1)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if there is none."""
        slot = self._slots(low, high)
        there = self.high[slot]
        hit = (there == high) & (self.low[slot] == low)
        out = np.where(hit, self.numbers[slot], -1)
        open_ = np.flatnonzero(~hit & (there != 0))
        while len(open_):
            slot[open_] = self._next(slot[open_])
            there = self.high[slot[open_]]
            hit = (there == high[open_]) & (self.low[slot[open_]] == low[open_])
            out[open_[hit]] = self.numbers[slot[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
        return out

    def add(self, low: np.ndarray, high: np.ndarray, numbers: np.ndarray) -> None:
        """New different words."""
        self.used += len(low)
        if self.used * 2 > len(self.low):
            old = self.high != 0
            low, high, numbers = np.r_[self.low[old], low], np.r_[self.high[old], high], np.r_[self.numbers[old], numbers]
            self._clear(1 << int(self.used * 2).bit_length())
        slot = self._slots(low, high)
        while len(low):
            free = np.flatnonzero(self.high[slot] == 0)
            _, one = np.unique(slot[free], return_index=True)
            take = free[one]
            self.low[slot[take]], self.high[slot[take]], self.numbers[slot[take]] = low[take], high[take], numbers[take]
            left = np.ones(len(low), bool)
            left[take] = False
            low, high, numbers, slot = low[left], high[left], numbers[left], self._next(slot[left])


class WordEncoder:
    """Encodes texts word by word; `encode` gets the different new words and returns all their ids and the number of each word's.

    Latin-1 texts are cut into words by array operations, and their words of up to SHORT bytes looked up whole in arrays;
    longer words, and those that the pattern cuts from other texts, in a dict. At most about `remember` words are held.
    """

    def __init__(self, special: dict[str, int], encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], remember: int = WORDS) -> None:
        self.special, self.encode, self.remember = special, encode, remember
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.short = WordIndex()
        self.new: list[bytes] = []
        self.known = 0
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _number(self, word: str) -> int:
        found = self.index.get(word)
        if found is None:
            found = self.index[word] = self.known + len(self.new)
            self.new.append(word.encode("utf-8", "surrogatepass"))
        return found

    def words_of(self, text: str) -> np.ndarray:
        """Numbers of the text's words; special strings, whole, are -1 - id."""
        if self.cut is None:
            return np.array([self._number(w) for w in self.find(text)], np.int64)
        return np.array([n for p in self.cut(text) if p for n in ([-1 - self.special[p]] if p in self.special else map(self._number, self.find(p)))], np.int64)

    def _latin(self, texts: list[bytes]) -> list[np.ndarray]:
        """As words_of(), of Latin-1 texts without special strings, none empty."""
        joined = b"".join(texts)
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        starts = latin_words(np.frombuffer(joined, np.uint8), begin)
        lengths = np.diff(np.r_[starts, len(joined)])
        word = lambda k: joined[starts[k] : starts[k] + lengths[k]].decode("latin-1")
        short = lengths <= SHORT
        low, high = word_keys(joined, starts, np.minimum(lengths, SHORT))
        numbers = np.full(len(starts), -1, np.int32)
        numbers[short] = self.short.find(low[short], high[short])
        for k in np.flatnonzero(~short):
            numbers[k] = self._number(word(k))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            missing = missing[np.lexsort((low[missing], high[missing]))]
            first = np.r_[True, (low[missing[1:]] != low[missing[:-1]]) | (high[missing[1:]] != high[missing[:-1]])]
            at, base = missing[first], self.known + len(self.new)
            self.new += [word(k).encode() for k in at.tolist()]
            self.short.add(low[at], high[at], np.arange(base, base + len(at), dtype=np.int32))
            numbers[missing] = base + np.cumsum(first) - 1
        return np.split(numbers, np.searchsorted(starts, begin[1:]))

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self.known > self.remember:
            self.reset()
        rows: list[np.ndarray | None] = [None] * len(texts)
        held, held_rows, size = [], [], 0
        for k, text in enumerate(texts):
            try:
                plain = text.encode("latin-1") if text and not any(s in text for s in self.special) else None
            except UnicodeEncodeError:
                plain = None
            if plain is None:
                rows[k] = self.words_of(text)
                continue
            held.append(plain)
            held_rows.append(k)
            size += len(plain)
            if size >= PIECE or k == len(texts) - 1:
                for i, row in zip(held_rows, self._latin(held)):
                    rows[i] = row
                held, held_rows, size = [], [], 0
        if held:
            for i, row in zip(held_rows, self._latin(held)):
                rows[i] = row
        if self.new:
            flat, counts = self.encode(self.new)
            self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
            self.known, self.new = self.known + len(self.new), []
        starts = np.cumsum(self.counts) - self.counts
        return [self._ids(row, starts) for row in rows]

    def _ids(self, row: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(row):
            return np.zeros(0, np.int32)
        special = row < 0
        if not special.any():
            return self.flat[spread(starts[row], self.counts[row])]
        lengths = np.where(special, 1, self.counts[np.maximum(row, 0)] if len(self.counts) else 1)
        out = np.zeros(lengths.sum(), np.int32)
        at = np.cumsum(lengths) - lengths
        out[at[special]] = -1 - row[special]
        words = row[~special]
        out[spread(at[~special], lengths[~special])] = self.flat[spread(starts[words], self.counts[words])]
        return out


def in_chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of at least `size` characters together, from batches of (id, text); null texts are empty."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1)):
            ids.append(i.as_py())
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


@lru_cache(2)
def pair_index_encoder(path: str) -> WordEncoder:
    """One for a worker, which knows the words of earlier tasks."""
    vocab = vocabulary(path)
    return WordEncoder(vocab.special, vocab.encode_words)


REMEMBERED.append(pair_index_encoder.cache_clear)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, ids array<int>): each whole text as the tokenizers library encodes it without special tokens added; null and empty texts have no ids."""
    path = path or tokenizer_path()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("id", _arrow_type(rows, "id")), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_index_encoder(path)
        for ids, texts in in_chunks(batches):
            made = encoder.texts(texts)
            ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids, schema.field(0).type), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made)))], schema=schema)

    return rows.mapInArrow(frugal(run, remembers=True), f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, ids_col: str = "ids", out_col: str = "text", path: str | None = None) -> DataFrame:
    """df with out_col in place of ids_col: the text of the ids, bytes that are not UTF-8 replaced; null ids give null."""
    path = path or tokenizer_path()
    rest = [c for c in df.columns if c != ids_col]
    rows = df.select(*rest, F.col(ids_col).alias(ids_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column(len(rest))
                texts = [vocab.decode(v.values.to_numpy().astype(np.int64)).decode("utf-8", "replace") if v.is_valid else None for v in column]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], pa.array(texts, pa.string())], names=[*rest, out_col])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest)
    return rows.mapInArrow(frugal(run), f"{kinds}{', ' if rest else ''}`{out_col}` string")


def round_trip_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): encode() and decode() in one pass over the texts, of which only digests leave Python."""
    path = path or tokenizer_path()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("id", _arrow_type(rows, "id")), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocab = pair_index_encoder(path), vocabulary(path)
        decimal = [str(i) for i in range(vocab.size)]
        for ids, texts in in_chunks(batches):
            made = encoder.texts(texts)
            sha = lambda data: hashlib.sha256(data).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, schema.field(0).type),
                    pa.array([len(m) for m in made], pa.int64()),
                    pa.array([sha(",".join(map(decimal.__getitem__, m.tolist())).encode()) for m in made]),
                    pa.array([sha(vocab.decode(m).decode("utf-8", "replace").encode()) for m in made]),
                ],
                schema=schema,
            )

    return rows.mapInArrow(frugal(run, remembers=True), f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(read_table(spark, sf_dir, "documents"))
