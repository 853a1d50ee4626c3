import hashlib
import random

import numpy as np
import pytest

from refloom.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, kept string, id long, spans string"


def brute(rows, length, keep):
    """Removed bytes of each row, window by window."""
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    data = [(r[1] or "").encode() for r in rows]
    for i in order:
        for p in range(len(data[i]) - length + 1):
            seen.setdefault(data[i][p : p + length], []).append((i, p))
    for i, text in enumerate(data):
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            places = seen[text[p : p + length]]
            if len(places) > 1 and (keep == "none" or (i, p) != places[0]):
                gone[p : p + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((rows[i][0], len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=1):
    r = random.Random(seed)
    words = ["alpha", "béta", "gamma", "delta", "ö", "epsilon", "zeta"]
    say = lambda n: " ".join(r.choice(words) + str(r.randrange(1000)) for _ in range(n))
    shared = [say(60), say(35), say(90)]
    texts = [None, "", "x", "a" * 5000, "a" * 250, "ab" * 300, "b" * 199, "c" * 200]
    for _ in range(40):
        parts = [say(r.randrange(1, 60))]
        for _ in range(r.randrange(3)):
            s = r.choice(shared)
            cut = r.randrange(0, 40)
            parts += [s[cut : len(s) - r.randrange(0, 40)], say(r.randrange(0, 30))]
        texts.append(r.choice(["", " "]).join(parts))
    texts += texts[10:14]
    long_ = say(3000)
    texts += [long_, long_[:5000] + "!" + long_[5000:]]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("keep", "hot", "chunk"), [("none", 16384, 1 << 21), ("first", 16384, 3000), ("none", 1, 3000), ("first", 1, 1 << 21)])
def test_against_brute_force(spark, monkeypatch, keep, hot, chunk):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], SCHEMA)
    spread = S.repeat_spans
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "repeat_spans", lambda *a: spread(*a, hot=hot))
    got = S.remove_repeats(df, keep=keep).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got), key=str)
    assert got == brute(rows, 200, keep)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(str(i * i) for i in range(100))
    rows = [(1, text), (1, text), (None, text[:300]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = len(text.encode())
    got = sorted((r.doc_id is None, r.n_removed) for r in S.remove_repeats(df, keep="none").collect())
    assert got == [(False, n), (False, n), (True, 0), (True, 300)]
    assert S.remove_repeats(df.limit(0)).count() == 0


def test_previous_factors():
    r = random.Random(1)
    for _ in range(60):
        length = r.choice([8, 13, 16, 20, 31, 32])
        data = "".join(r.choice("aaaaaaab") for _ in range(r.randrange(length, 300))).encode() * r.choice([1, 1, 2])
        starts = [p for p in range(len(data) - length + 1) if r.random() < 0.8]
        windows = [data[p : p + length] for p in starts]
        longest = [max([0, *(next((k for k in range(length) if w[k] != windows[j][k]), length) for j in range(i))]) for i, w in enumerate(windows)]
        earlier = S.previous_factors(np.frombuffer(data, np.uint8), np.array(starts, int), length)
        assert [e >= 0 for e in earlier] == [n == length for n in longest]
        assert all(e < i and windows[e] == windows[i] for i, e in enumerate(earlier) if e >= 0)


def test_previous_smaller():
    r = np.random.default_rng(2)
    for v in (*(r.permutation(n) for n in (0, 1, 2, 50, 300)), np.arange(99), np.arange(99)[::-1]):
        assert S.previous_smaller(v).tolist() == [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(len(v))]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_a_text_that_repeats_itself_with_periods_about_the_grams_of_a_window(spark, keep):
    r = random.Random(4)
    rows = []
    for period in (168, 169, 170):
        for times in (3, 7, 20):
            rows.append((len(rows), ("".join(r.choice("abcdefgh ") for _ in range(period - 1)) + "\n") * times))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(bytes(x.kept)).hexdigest()) for x in S.remove_repeats(df, keep=keep).collect()), key=str)
    assert got == brute(rows, 200, keep)


def test_minimizers_that_repeat_across_batches():
    """However the rows are cut into batches, those whose minimizer another row stands for stay, and known ones."""
    r = random.Random(4)
    mh = sorted(r.choice(range(40)) for _ in range(60))
    rows = sorted([(m, m, False) for m in mh] + [(r.randrange(40), r.randrange(40, 50), True) for _ in range(20)], key=lambda x: x[1])
    want = sorted(m for m, route, known in rows if known or mh.count(m) > 1)
    for size in (1, 2, 3, 7, 100):
        parts = [rows[k : k + size] for k in range(0, len(rows), size)]
        batches = [S.pa.RecordBatch.from_arrays([S.pa.array(c, t) for c, t in zip(zip(*p), (S.pa.int64(), S.pa.int64(), S.pa.bool_()))], names=["mh", "route", "known"]) for p in parts]
        assert sorted(m for b in S._repeated_minimizers(iter(batches)) for m in b.column("mh").to_pylist()) == want
