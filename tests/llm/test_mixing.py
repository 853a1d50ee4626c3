import math
import random
import re
from decimal import Decimal

import pytest

from refloom.llm import mixing as M


def slow_targets(sizes, weights, share, limit):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > limit * sizes[s]}
        if not over:
            target |= {s: level * w[s] for s in open_}
            break
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def slow_copies(members, target, limit):
    """{place in members: copies} of one source's (id, size): the tilt by halving an interval, then copies by size and id."""
    total = sum(z for _, z in members)
    if not total or not target:
        return dict.fromkeys(range(len(members)), 0)
    rate = lambda t, z: limit if t * z > 700 else min(limit, math.exp(t * z))
    low, high = -60.0, math.log(limit) + 1e-9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if math.fsum(z * rate(mid, z) for _, z in members) < target else (low, mid)
    if target >= limit * total * (1 - 1e-12):
        high = 60.0
    out, at = {}, Decimal("0.5")
    for k in sorted(range(len(members)), key=lambda k: (-members[k][1], members[k][0] is not None, members[k][0] or 0)):
        r = round(Decimal(rate(high, members[k][1])), 12)
        out[k] = math.floor(at + r) - math.floor(at)
        at += r
    return out


def rows():
    r = random.Random(2)
    sources = ["b", "a", "Ω", "\U0001f600", "￿", "", None, "tiny"]
    out = [(i, r.choice(sources[:-1]), " ".join("w" for _ in range(r.randrange(200)))) for i in range(600)]
    out += [(600, "tiny", "one"), (601, "empty", None), (602, "empty", ""), (None, "a", "null id"), (5, "a", "x y"), (5, "a", "x y"), (700, "b", "w " * 20000), (701, "nb", "a\xa0b c\x0bd\x1ce")]
    return out + [(1000 + i, "copies", "same text here") for i in range(300)]


def test_targets_and_copies(spark):
    df = spark.createDataFrame([(i, s, t, 1, "x") for i, s, t in rows()], "doc_id long, source string, text string, size int, target string")
    got = M.mix_sources(df).collect()
    assert len(got) == len(rows())
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, s, t in rows():
        sizes[s] = sizes.get(s, 0) + count(t)
    want = slow_targets(sizes, M.WEIGHTS, M.SHARE, M.LIMIT)
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), count(t)) for i, _, t in rows())
    for s in sizes:
        members = [(i, count(t)) for i, of, t in rows() if of == s]
        copies = slow_copies(members, want[s], M.LIMIT)
        mine = [(r.doc_id, r["size"], r.copies) for r in got if (r.source_size, round(r.target, 6)) == (sizes[s], round(want[s], 6)) and any((r.doc_id, r["size"]) == m for m in members)]
        if sum(v == sizes[s] for v in sizes.values()) == 1:
            assert sorted(mine, key=str) == sorted(((*members[k], c) for k, c in copies.items()), key=str)
    by_size = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    assert sorted({(sizes[s], round(t, 6)) for s, t in want.items()}) == sorted(by_size)
    for (_, target), members in by_size.items():
        n = sum((sizes[s], round(want[s], 6)) == (members[0].source_size, target) for s in want)
        assert abs(sum(r.taken for r in members) - n * target) <= n * (max(r["size"] for r in members) / 2 + 1e-6)
    assert sorted(map(str, got)) == sorted(map(str, M.mix_sources(df.repartition(7)).collect()))


@pytest.mark.parametrize("data", [[], [(1, None, None)], [(1, "a", "")], [(1, "a", "one two")]])
def test_small_tables(spark, data):
    got = M.mix_sources(spark.createDataFrame(data, "doc_id long, source string, text string")).collect()
    assert len(got) == len(data) and all(r.taken in (0, 2, 4) for r in got)


def test_mixed_rows(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "w " * (i + 1), i) for i in range(50)], "doc_id long, source string, text string, size int")
    copies = {r.doc_id: r.copies for r in M.mix_sources(df).collect()}
    got = {}
    for r in M.mixed_documents(df).collect():
        assert (r["size"], r.text) == (r.doc_id, "w " * (r.doc_id + 1))
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in copies.items() if v}


@pytest.mark.parametrize(("share", "limit"), [(0.01, 2.0), (0.7, 2.0), (30.0, 60.0), (90.0, 100.0), (700.0, 1000.0), (5000.0, 1000.0)])
def test_rates_are_tilted_by_size_and_meet_the_target(spark, share, limit):
    r = random.Random(5)
    docs = [(i, "abcd"[i % 4], " ".join("w" for _ in range(int(r.lognormvariate(3, 1.2))))) for i in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    got = M.mix_sources(df, share=share, limit=limit).collect()
    by = {}
    for x in got:
        by.setdefault(x.source_size, []).append(x)
    for size, members in by.items():
        members.sort(key=lambda x: (-x["size"], x.doc_id))
        copies = slow_copies([(x.doc_id, x["size"]) for x in members], members[0].target, limit)
        assert [x.copies for x in members] == [copies[k] for k in range(len(members))]
        assert members[0].target <= limit * size * (1 + 1e-12) and all(0 <= x.copies <= limit for x in members)
        assert abs(sum(x.taken for x in members) - members[0].target) <= max(x["size"] for x in members) / 2 + 1e-6


def test_steps_end_by_the_residual(spark):
    sizes = spark.createDataFrame([("a", 5, 100), ("b", 1, 50), ("b", 7, 9), ("b", 9000, 2), (None, 3, 4), ("zero", 0, 5)], "source string, size long, n_size long")
    targets = spark.createDataFrame([("a", 500, 125.0), ("b", 18113, 20000.0), (None, 12, 24.0), ("zero", 0, 0.0)], "source string, source_size long, target double")
    got = {r.source: r.tilt for r in M.balanced_tilts(targets, sizes).collect()}
    assert abs(got["a"] - math.log(0.25) / 5) < 1e-12 and got["zero"] is None and got[None] * 3 >= math.log(2)
    took = sum(n * z * min(2, math.exp(got["b"] * z)) for z, n in ((1, 50), (7, 9), (9000, 2)))
    assert abs(took - 20000) < 1e-7
