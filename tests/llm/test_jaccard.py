import random

import numpy as np
import pytest
from test_simhash import near_copies

from refloom.llm import jaccard as J
from refloom.llm.simhash import _words, local_roots

SCHEMA = "doc_id long, text string, w0 int, tokens string"


def sets_of(rows):
    out = []
    for _, t in rows:
        w = _words(t)
        n = max(1, min(5, len(w)))
        out.append(frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))))
    return out


def exact(rows):
    """Components by comparing the shingles of all pairs."""
    sets, a, b = sets_of(rows), [], []
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 5 * len(x & y) >= 4 * len(x | y):
                a.append(i)
                b.append(j)
    low, root = {}, local_roots(len(rows), np.array(a, int), np.array(b, int))
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(i, low.get(r, i))
    return sorted(((i, low.get(r)) for (i, _), r in zip(rows, root)), key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA).repartition(3)
    return sorted(((r.doc_id, r.component_id) for r in J.similar_documents(df, **options).collect()), key=str)


def test_links_are_those_of_exact_jaccard(spark):
    rows, _ = near_copies()
    rows += [(None, rows[-1][1]), (None, None), (5, "twice"), (5, "twice"), (7000, " ".join(["same"] * 60000))]
    # 4 and 5 shingles (0.8), 3 and 4 (0.75)
    rows += [(7100, "a b c d e f g h"), (7101, "a b c d e f g h i"), (7102, "k l m n o p q"), (7103, "k l m n o p q r")]
    assert found(spark, rows) == exact(rows)
    assert J.similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def block_edits(seed=9):
    """Pairs that a replaced, appended or cut-off block takes to a similarity of 0.8 to 0.85."""
    r = random.Random(seed)
    rows = []
    new = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    for k in range(60):
        base = new(300)
        at = r.randrange(240)
        other = ([*base[:at], *new(25), *base[at + 25 :]], base + new(60), base[:245])[k % 3]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    return rows


def test_block_edits_are_linked_at_any_size_of_the_corpus(spark, monkeypatch):
    rows = block_edits()
    sets = sets_of(rows)
    told = [len(x & y) / len(x | y) for x, y in zip(sets[::2], sets[1::2])]
    assert 0.8 <= min(told) and max(told) < 0.86
    want = [(i, i - i % 2) for i, _ in rows]
    assert sorted(found(spark, rows)) == want
    monkeypatch.setattr(J, "OFTEN", 2)  # what both texts of a pair have counts as frequent, as in a far larger sample
    assert sorted(found(spark, rows)) == want


def test_prefixes_of_similar_sets_meet_in_any_order():
    r = np.random.default_rng(3)
    for n in (*range(1, 30), 400):
        for gone in range(n // 5 + 1):
            x = np.sort(r.integers(0, 1 << 63, n, np.uint64))
            y = np.sort(r.permutation(x)[gone:])
            often = np.sort(r.permutation(x)[: n // 2])
            counts = r.integers(8, 90, len(often))
            first = [np.concatenate(J.prefix(h, 0.8, often, counts)) for h in (x, y)]
            assert not J.alike(x, y, 0.8) or np.isin(*first).any()


def test_crowds_are_dealt_out_exactly(spark):
    """Groups of hundreds of near copies in blocks of at most 20: every component is right."""
    rows, _ = near_copies(n_docs=3, copies=400)
    assert found(spark, rows, most=20) == exact(rows)


def test_heavy_places_are_dealt_out_exactly(spark):
    """Few texts, but long for the bound on shingles: every component is right, also where one text alone is above it."""
    rows, _ = near_copies(n_docs=3, copies=60)
    sizes = [len(x) for x in sets_of(rows)]
    assert found(spark, rows, heavy=8 * max(sizes)) == exact(rows)
    assert found(spark, rows[:40], heavy=max(sizes) - 1) == exact(rows[:40])


def one_word_edits(n=40, seed=4):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        base = [f"w{r.randrange(9000)}" for _ in range(900)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join([*base[:-1], "edit"]))]
    return rows


def test_fingerprints_meet_by_anchor_point_covering(spark, monkeypatch):
    """Texts whose SimHash differs in at most two bits are brought together and judged without any prefix."""
    rows = one_word_edits()
    w0 = [int(J._sums(J.shingles(t)).view(np.int64)[0]) for _, t in rows]
    bits = np.array([[((x ^ y) & (1 << 64) - 1).bit_count() for y in w0] for x in w0])
    a, b = np.nonzero(np.triu(bits <= 2, 1))
    root = local_roots(len(rows), b, a)
    want = [(i, int(r)) for (i, _), r in zip(rows, root)]
    assert len(a) > 20
    nodes = spark.createDataFrame([(i, 9, w) for (i, _), w in zip(rows, w0)], "node long, n long, w0 long")
    groups = {}
    for r in J.fingerprint_places(nodes).collect():
        groups.setdefault(r.place, []).append(r.node)
    assert sorted(sorted(g) for g in groups.values()) == sorted(sorted(i for i, r in want if r == k) for k in {r for i, r in want if r != i})
    monkeypatch.setattr(J, "_places", lambda nodes: nodes.select(nodes.node.alias("place"), "node", "n").limit(0))
    assert sorted(found(spark, rows)) == want


def test_what_fingerprints_bring_together_is_judged(spark, monkeypatch):
    """All texts at one fingerprint: only similar ones are linked."""
    monkeypatch.setattr(J, "fingerprint_places", lambda nodes: nodes.select(nodes.node * 0, "node", "n").toDF("place", "node", "n"))
    rows = one_word_edits(10) + block_edits()[:30]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert found(spark, rows) == exact(rows)
    assert found(spark, rows, most=8) == exact(rows)
