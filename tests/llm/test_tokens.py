import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from refloom.llm import bpe as B
from refloom.llm import chat as C
from refloom.llm import token_store as T
from refloom.llm.common import work_path

PATH = B.tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)


def texts():
    r = random.Random(3)
    mixed = "aàb céA'sreldm 12½²\t\n  .,!?-_　 \x1c\x1f\x85中文字é̀🙂ſİ"
    latin = "''' \t\nsstremvld.,aé1\xa0\x85"
    rows = ["", None, "<|endoftext|>", "a<|endoftext|> <|endoftext|>b<|endoftext|", "   ", "  \n \n x", "aaaaaaaaaaaaa", "a" * 30000, "ab" * 5000 + " " * 3000, "don't 'tis 're'll''s 's"]
    rows += ["".join(r.choice(mixed) for _ in range(r.randrange(60))) for _ in range(200)]
    rows += ["".join(r.choice(latin) for _ in range(r.randrange(30))) for _ in range(600)]
    rows += [w for n in (8, 15, 16, 1024, 2048) for w in twins(n)] + [" ".join(twins(1024)), "a\0 b\0\0 c\0b", "\0", "\0\0", "123456789012345 1234567890123456 12345678901234567 12345678"]
    return rows + rows[3:6]


def twins(n):
    """Words of one length that polynomial hashes modulo a power of two don't tell apart: a Thue-Morse word and its complement."""
    word = "".join("ab"[k.bit_count() & 1] for k in range(n))
    return [word, word.translate(str.maketrans("ab", "ba"))]


def want_ids(rows):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in rows], add_special_tokens=False)]


@pytest.mark.parametrize("make", [B.pair_index_encoder, T.library_encoder])
def test_encoders_agree_with_the_library(monkeypatch, make):
    rows = [t or "" for t in texts()]
    encoder = make(PATH)
    encoder.reset()
    monkeypatch.setattr(encoder, "remember", 100)  # forgets between the two calls
    for part in (rows[::2], rows[1::2]):
        assert [m.tolist() for m in encoder.texts(part)] == want_ids(part)


def test_words_that_meet_in_the_index_are_told_apart(monkeypatch):
    r = random.Random(7)
    words = list(dict.fromkeys("".join(r.choice("ab\0é") for _ in range(r.randrange(1, 16))).encode("latin-1") for _ in range(3000)))
    data, lengths = b"".join(words), np.array([len(w) for w in words])
    low, high = B.word_keys(data, np.cumsum(lengths) - lengths, lengths)
    index = B.WordIndex(4)
    monkeypatch.setattr(index, "_slots", lambda low, high: low & np.uint64(3))  # nearly all meet
    for k in range(0, len(words), 100):
        index.add(low[k : k + 100], high[k : k + 100], np.arange(k, min(k + 100, len(words)), dtype=np.int32))
    assert index.find(low, high).tolist() == list(range(len(words)))
    assert (index.find(low ^ np.uint64(1 << 63), high | np.uint64(1 << 55)) == -1).all()


def test_words_by_arrays_agree_with_the_pattern():
    r = random.Random(9)
    find = B.regex.compile(B.PATTERN).findall
    rows = ["".join(r.choice("'''  \t\nsstremvld.,aé1½") for _ in range(r.randrange(1, 25))) for _ in range(5000)]
    rows += ["".join(chr(r.randrange(256)) for _ in range(40)) for _ in range(500)]
    data = "".join(rows).encode("latin-1")
    sizes = [len(t) for t in rows]
    starts = B.latin_words(np.frombuffer(data, np.uint8), np.cumsum(sizes) - sizes)
    assert np.split(np.frombuffer(data, np.uint8), starts[1:])[-1].tobytes() == find(rows[-1])[-1].encode("latin-1")
    assert [data[a:b].decode("latin-1") for a, b in zip(starts, [*starts[1:], len(data)])] == [w for t in rows for w in find(t)]


def test_op6_against_the_library(spark):
    rows = list(enumerate(texts())) + [(None, "null id"), (1, "twice"), (1, "twice")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, ids int, n_tokens string")
    want = sorted(((i, len(k), hashlib.sha256(",".join(map(str, k)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(k, skip_special_tokens=False).encode()).hexdigest()) for (i, _), k in zip(rows, want_ids([t for _, t in rows]))), key=str)
    assert sorted((tuple(r) for r in B.round_trip_digests(df).collect()), key=str) == want
    coded = B.encode(df)
    assert sorted((r.doc_id, r.text) for r in B.decode(coded).collect() if r.doc_id is not None) == sorted((i, t or "") for i, t in rows if i is not None)
    assert B.encode(df.limit(0)).count() == 0


def test_rans_round_trip():
    r = np.random.default_rng(1)
    for stream, counts in ((r.integers(0, 50000, 5000), [5000]), (np.full(3000, 7), [1000, 2000]), (r.geometric(0.3, 200_000), [199_990, 9, 1])):
        stream, counts = stream.astype(np.int64), np.array(counts)
        symbols, freq = T.frequency_table(stream)
        assert freq.sum() == 1 << T.BITS and freq.min() > 0
        state, words = T.rans_encode(symbols, freq, stream, counts)
        assert (T.rans_decode(symbols, freq, state, words, counts) == stream).all()
    few = np.concatenate([np.arange(40_000), np.zeros(10_000_000, np.int64)])
    symbols, freq = T.frequency_table(few)
    assert freq.sum() == 1 << T.BITS and freq.min() == 1


def test_damage_is_found():
    data = bytearray(T.pack_segment(T.pa.array([1]), [np.arange(2000, dtype=np.int32)], 0, 0))
    for at in (9, 60, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises((ValueError, zlib.error)):
            T.unpack_segment(bytes(broken))


def test_op4_reads_back(spark, monkeypatch):
    monkeypatch.setattr(T, "in_chunks", lambda batches: B.in_chunks(batches, 500))
    rows = list(enumerate(texts()))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i * 3, t, 0) for i, t in rows], "doc_id long, text string, start int")
    out = work_path(spark, "t")
    T.write_tokens(df, out, partitions=5)
    got = sorted(T.read_tokens(spark, out).collect())
    start, want = 0, []
    for (i, _), ids in sorted(zip(rows, want_ids([t for _, t in rows]))):
        ids = [*ids, T.END_ID]
        want.append((i * 3, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_op4_odd_tables(spark):
    for rows in ([], [(None, "a"), (1, "b"), (1, "b"), (1, None)]):
        out = work_path(spark, "t")
        T.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), out)
        got = T.read_tokens(spark, out, with_ids=False).collect()
        assert len(got) == len(rows) and sorted(r.start for r in got) == sorted(np.cumsum([0, *(r.n_tokens for r in sorted(got, key=lambda r: r.start))])[:-1].tolist())


def test_chat(spark):
    r = random.Random(4)
    bits = ["\\", "###", "</turn>", ":", " ", "ok", "é🙂", "\n", "<|endoftext|>", "#"]
    say = lambda: "".join(r.choice(bits) for _ in range(r.randrange(12)))
    rows = [(c, t, r.choice(["user", "assistant", "a:b", "###", None]), r.choice([say(), None, ""])) for c in range(20) for t in range(r.randrange(1, 6))]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (50, 1, "assistant", "same"), (50, 1, "assistant", "same"), (51, 0, "assistant", "long \\" * 30000)]
    rows += [(60, k, "assistant", w) for k, w in enumerate(twins(1024))]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, rank int")
    turns = C.format_turns(df)
    for t in turns.collect():
        assert sum(t.loss) <= len(t.ids) - 3 and len(t.ids) == len(t.loss)
    got = sorted((tuple(x) for x in C.digests(turns).collect()), key=str)
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    want = []
    for c, turn in by.items():
        turn.sort(key=lambda x: x[:3])
        said = "".join(x[3] for x in turn if x[2] == "assistant")
        whole = "".join(f"### {C.escape(x[2], C.ROLE_MARKED)}: {C.escape(x[3])} </turn>\n" for x in turn)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((c, len(turn), sha("".join(f"{x[2]}\n{x[3]}\n" for x in turn)), len(said), sha(said), len(whole)))
    assert got == sorted(want, key=str)
    assert C.digests(C.format_turns(df.limit(0))).count() == 0


def test_escapes_reverse():
    r = random.Random(8)
    for _ in range(3000):
        text = "".join(r.choice(["\\", "#", "###", "</turn>", "<", ":", "a"]) for _ in range(r.randrange(10)))
        assert C.unescape(C.escape(text)) == text == C.unescape(C.escape(text, C.ROLE_MARKED))
        units = C.re.findall(r"\\(?:\\|###|</turn>)|###|</turn>|.", C.escape(text))
        assert "###" not in units and "</turn>" not in units


def test_encoding_new_words_takes_bounded_memory():
    """Symbols and links are 32-bit, and pairs are looked up some at a time."""
    import tracemalloc

    vocab, r = B.vocabulary(B.tokenizer_path()), random.Random(2)
    words = list({"".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=9)).encode() for _ in range(120_000)})
    tracemalloc.start()
    vocab.encode_words(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(len(w) + 1 for w in words)


def test_words_are_remembered_by_encoders_only():
    from refloom.llm.common import frugal

    path = B.tokenizer_path()
    kept = B.pair_index_encoder(path)
    list(frugal(iter, remembers=True)([]))
    assert B.pair_index_encoder(path) is kept
    list(frugal(iter)([]))
    assert B.pair_index_encoder(path) is not kept
