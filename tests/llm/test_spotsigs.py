import hashlib
import re

from pyspark.sql import functions as F

from refloom.llm import spotsigs as S

ANCHORS = {w for line in S.ANCHORS.values() for w in line.split()}
TEXTS = ["The house of the old man was on a hill and the dog is in it", "das Haus und der alte Mann ist auf dem Berg", "", None, "one", "...", "x" * 50000, "the " * 20000, "the cat " * 3000, "É la maison du vieux 🙂 homme", "only content words here", "the end"]


def slow_signatures(text):
    words = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
    chains = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            rest = [v for v in words[i + 1 :] if v not in ANCHORS][: S.CHAIN]
            if len(rest) == S.CHAIN:
                chains.add(tuple(rest))
    return {" ".join(c) for c in chains} or ({" ".join(words)} if words else set())


def test_signatures_and_edits(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(20, TEXTS[0]), (None, "null id the cat sat there")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, half int, head string")
    got = {r.doc_id: r for r in S.compare_with_edits(df).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    code = {s: h for s, h in spark.createDataFrame([(s,) for _, t in rows for s in slow_signatures(t)], "s string").select("s", F.hash("s")).collect()}
    hashes = lambda t: sorted({code[s] if s in code else spark.range(1).select(F.hash(F.lit(s))).first()[0] for s in slow_signatures(t)})
    near = lambda a, b: 1.0 if not a and not b else len(set(a) & set(b)) / len(set(a) | set(b))
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{h & 0xFFFFFFFF:08x}" for h in hashes(t)), t[:50]
        assert abs(r.near_edited - near(hashes(t), hashes(edited))) < 1e-12
        assert abs(r.near_next - near(hashes(t), hashes(after))) < 1e-12


def test_small_tables(spark):
    assert S.compare_with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = S.compare_with_edits(spark.createDataFrame([(4, "the big dog is old")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    twice = S.compare_with_edits(spark.createDataFrame([(4, "a b"), (4, "a b"), (4, "c d"), (4, None)], "doc_id long, text string")).collect()
    assert len(twice) == 4


def test_pruning_is_exact(spark):
    df = spark.sql("select sequence(1, a) x, sequence(b, b + c) y from (select explode(sequence(1, 12)) a), (select explode(sequence(1, 9)) b), (select explode(sequence(0, 9)) c)")
    for t in (0.5, 0.8):
        rows = df.select(S.likeness(F.col("x"), F.col("y")).alias("all"), S.likeness(F.col("x"), F.col("y"), t).alias("cut"), S.length_class(F.col("x"), t).alias("i"), S.length_class(F.col("y"), t).alias("j")).collect()
        for r in rows:
            assert r.cut == (r["all"] if r["all"] >= t else 0.0)
            assert r["all"] < t or abs(r.i - r.j) <= 1


def test_search_is_exact(spark):
    import random

    r = random.Random(4)
    words = ["the", "of", "cat", "dog", "sun", "der", "haus", "la", "old", "new", "sea", "air"]
    base = [[r.choice(words) for _ in range(r.randrange(3, 60))] for _ in range(12)]
    rows = [(None, ""), (900, None)]
    for b in base:
        for k in range(5):
            w = list(b)
            for _ in range(k):
                w[r.randrange(len(w))] = r.choice(words)
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, set int")
    sets = {i: slow_signatures(t) for i, t in rows if slow_signatures(t)}
    for t in (0.5, 0.8):
        got = sorted((x.query_id, x.id, round(x.likeness, 9)) for x in S.similar_pairs(df.where("doc_id % 3 = 0"), df, threshold=t).collect())
        want = sorted((a, b, round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9)) for a in sets if a is not None and a % 3 == 0 for b in sets if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t)
        assert got == want and len(got) > len([a for a in sets if a is not None and a % 3 == 0])
