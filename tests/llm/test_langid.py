import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from refloom.llm import langid as L

WORDS = {
    "en": "the of and to in that is was for with his they this have from house water would people",
    "de": "der die und das nicht ist ein eine mit auf dem haus wasser würde leute schön straße über",
    "fr": "le la les des est une dans pour que qui avec maison eau être même où ça très",
    "es": "el los las una que con para por casa agua gente señor mañana está más año niño",
    "xx": "qxz zzq qqx xzx zxq qzx xqz",
}


def corpus():
    r = random.Random(1)
    return [(i, " ".join(r.choice(WORDS[lang].split()) for _ in range(r.randrange(3, 60))), lang) for i, lang in enumerate(list(WORDS) * 60)]


def test_held_out_accuracy_and_odd_texts(spark):
    odd = [(9000, None, "en"), (9001, "", "de"), (9002, "123 .. !", "fr"), (9003, "the house of people", None), (9004, "the water " * 60000, "en"), (None, "la maison", "fr"), (5, "the same the same", "en"), (5, "the same the same", "en")]
    df = spark.createDataFrame([(*r, 1, "x") for r in corpus() + odd], "doc_id long, text string, lang string, score int, c0 string")
    model = L.learn(df)
    got = L.identify(df.withColumn("held_out", L.held_out(F.col("doc_id"))), model).collect()
    assert len(got) == len(corpus()) + len(odd)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    test = [(i, lang) for i, _, lang in corpus() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, _ in test} <= {r.doc_id for r in got if r.held_out}
    assert np.mean([by[i].lang_pred == lang for i, lang in test]) > 0.97
    assert {by[i].lang_pred for i in (9000, 9001, 9002)} == {"und"} and by[9003].lang_pred == by[9004].lang_pred == "en"
    assert all(0 <= r[-1] <= 1 for r in got)


def test_held_out_rows_teach_nothing(spark):
    rows = corpus()
    lied = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    a, b = (L.learn(spark.createDataFrame(x, "doc_id long, text string, lang string")) for x in (rows, lied))
    assert all((a.machines[k] == b.machines[k]).all() for k in a.machines) and a.machines.keys() == b.machines.keys()


def test_bound_and_empty(spark, monkeypatch):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    small = L.learn(df, per_lang=5)
    assert small.families == L.learn(df).families
    monkeypatch.setattr(L, "SAMPLE", 50)
    few = L.learn(df, per_lang=10)
    monkeypatch.setattr(L, "SAMPLE", 10**9)
    assert all((few.machines[k] == w).all() for k, w in L.learn(df, per_lang=10).machines.items())
    empty = L.learn(df.limit(0))
    assert {r.lang_pred for r in L.identify(df, empty).collect()} == {"und"} and L.identify(df.limit(0), small).count() == 0
    one = L.learn(df.where("lang = 'en'"))
    assert {r.lang_pred for r in L.identify(df, one).collect()} == {"en"}


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = corpus()[0][1] * 20
    whole = L.features(text)
    monkeypatch.setattr(L, "PIECE", 7)
    assert np.allclose(whole, L.features(text))


def test_against_a_plain_version():
    """Family first, then its languages: votes of one-versus-one machines, written out for each text."""
    rows = corpus()
    model = L.Model(np.stack([L.features(t) for _, t, _ in rows]), [lang for _, _, lang in rows])

    def vote(kind, names, x):
        votes, sums, least = ({n: v for n in names} for v in (0, 0.0, np.inf))
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                w = model.machines[kind, a, b]
                m = float(np.dot(x, w[:-1]) + w[-1])
                votes[a if m > 0 else b] += 1
                for n, v in ((a, m), (b, -m)):
                    sums[n] += v
                    least[n] = min(least[n], v)
        best = sorted(names, key=lambda n: (votes[n], sums[n], n))[-1]
        return best, 1.0 if len(names) == 1 else 1 / (1 + np.exp(-2 * least[best]))

    texts = [t for _, t, _ in rows[::7]] + ["casa maison haus", "the die la", "zzq"]
    for text, (lang, score) in zip(texts, model.predict(texts)):
        x = L.features(text)
        family, p = vote("family", sorted(model.families), x)
        want, q = vote("lang", model.families[family], x)
        assert lang == want and L.family_of(lang) == family and abs(score - p * q) < 1e-4
    pairs = {k[0] for k in model.machines}
    assert pairs == {"family", "lang"} and all(L.family_of(a) == L.family_of(b) for kind, a, b in model.machines if kind == "lang")
