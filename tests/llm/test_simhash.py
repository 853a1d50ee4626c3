import random

import numpy as np
import pytest
import xxhash

from refloom.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, anchor int, component_id string"


def slow_print(text):
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(prints, limit=2):
    ids = [i for i, _ in prints]
    comp = {k: k for k in range(len(prints))}
    changed = True
    while changed:
        changed = False
        for a in comp:
            for b in comp:
                if comp[b] < comp[a] and bin(prints[a][1] ^ prints[b][1]).count("1") <= limit:
                    comp[a], changed = comp[b], True
    out = {}
    for k, c in comp.items():
        out.setdefault(c, []).append(ids[k])
    low = {c: min((i for i in v if i is not None), default=None) for c, v in out.items()}
    return sorted(((ids[k], prints[k][1], low[c]) for k, c in comp.items()), key=str)


def texts():
    r = random.Random(5)
    base = [" ".join(r.choice("alpha beta gamma delta épsilon Zeta".split()) + str(r.randrange(50)) for _ in range(n)) for n in (1, 2, 3, 40, 400, 3000)]
    rows = [None, "", " \t\n", "A", "a", "É", "é", *base, *base[:3]]
    for b in base[3:]:
        for _ in range(4):
            w = b.split()
            w[r.randrange(len(w))] = "edited"
            rows.append(" ".join(w))
    rows.append("long " * 50000)
    return rows


@pytest.mark.parametrize("hot", [16384, 1])
def test_against_brute_force(spark, monkeypatch, hot):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a"), (3, "A")]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    near = S.near_fingerprints
    monkeypatch.setattr(S, "near_fingerprints", lambda fps, limit: near(fps, limit, hot=hot))
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    assert got == slow_components([(i, slow_print(t)) for i, t in rows])


def test_dense_cluster_of_fingerprints(spark):
    """Chains and crowds around one point: all links are found, at any size of group."""
    r = random.Random(2)
    prints = {0x1234567890ABCDEF ^ sum(1 << b for b in r.sample(range(64), r.randrange(6))) for _ in range(400)} | {r.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    want = {i: low for i, _, low in slow_components(list(enumerate(prints)))}
    for hot in (16384, 8):
        edges = [(e.a & (1 << 64) - 1, e.b & (1 << 64) - 1) for e in S.near_fingerprints(df, hot=hot).collect()]
        at = {p: k for k, p in enumerate(prints)}
        root = S.local_roots(len(prints), np.array([at[a] for a, _ in edges]), np.array([at[b] for _, b in edges]))
        assert root.tolist() == [want[k] for k in range(len(prints))]


def test_anchors_cover():
    x = np.random.default_rng(3).integers(0, 1 << 63, 5000, np.uint64)
    a = S.anchor_of(x)
    assert (S.anchor_of(a) == a).all() and np.bitwise_count(x ^ a).max() <= 7


def test_empty_table_and_kept_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(empty).count() == 0
    rows = [(2, "one two three four"), (1, "one two three four"), (3, "else"), (None, "else")]
    kept = S.keep_first(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)).collect()
    assert sorted((r.doc_id, r.fp) for r in kept if r.doc_id is not None) == [(1, "x"), (3, "x")]


def near_copies(n_docs=12, copies=60, seed=6):
    """(rows, {id: (base, similarity of five-word shingles to it)}): every base has copies with from none to many words changed."""
    r = random.Random(seed)
    rows, told = [(i, t) for i, t in enumerate(texts()[:12])], {}
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for d in range(n_docs):
        base = [f"w{r.randrange(3000)}" for _ in range(r.randrange(80, 500))]
        for k in range(copies if d == 0 else 5):
            w = list(base)
            for _ in range(r.randrange(1, 12) if k else 0):
                w[r.randrange(len(w))] = "new"
            told[len(rows)] = (d, len(shingles(w) & shingles(base)) / len(shingles(w) | shingles(base)))
            rows.append((len(rows), " ".join(w)))
    return rows, told
