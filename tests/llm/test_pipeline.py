"""The pipeline against a version that does each stage plainly, on a small corpus with copies, near copies, repeats and odd rows."""

import random
import re

import numpy as np
import pytest
from test_jaccard import exact
from test_suffix_dedup import corpus
from tokenizers import Tokenizer

import corpus_pipeline as P
from refloom.llm import langid
from refloom.llm.bpe import tokenizer_path
from refloom.llm.mixing import LIMIT, SHARE, WEIGHTS
from test_mixing import slow_copies, slow_targets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"


def documents():
    r = random.Random(11)
    words = {"en": "the of and to house water would people that".split(), "de": "der die und haus wasser würde leute straße nicht".split()}
    rows = [(i, t, "en", r.choice(["a", "b", None])) for i, t in corpus(3)]
    for i in range(100, 220):
        lang = r.choice(["en", "de"])
        rows.append((i, " ".join(r.choice(words[lang]) + str(r.randrange(99)) for _ in range(r.randrange(1, 80))), r.choice([lang, lang, None]), r.choice(["a", "b", "c", None])))
    long_ = " ".join(r.choice(words["en"]) + str(k % 97) for k in range(700))
    rows += [(300, long_, "en", "a"), (301, long_, "en", "b"), (302, long_ + " tail", "en", "a"), (303, "12 34 --", "en", "a"), (304, None, None, None)]
    return [(i, t, lang, s, len(t or ""), 1) for i, t, lang, s in rows]


def cut(rows, length=200):
    """Texts without the bytes of windows that occur earlier, by id and position."""
    seen, out = set(), []
    for i, text, *rest in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        left = bytes(np.frombuffer(data, np.uint8)[~gone]).decode("utf-8", "ignore")
        if left.strip(" "):
            out.append((i, left, *rest))
    return out


def mixed(rows):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, *_ in rows}
    sizes = {}
    for i, _, _, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    targets, out = slow_targets(sizes, WEIGHTS, SHARE, LIMIT), []
    for s in sizes:
        members = [r for r in rows if r[3] == s]
        for k, copies in slow_copies([(r[0], size[r[0]]) for r in members], targets[s], LIMIT).items():
            out += [members[k]] * copies
    return out


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    sf_dir = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{sf_dir}/documents.parquet")
    return spark, sf_dir, P.run(spark, sf_dir).collect()


def test_stages_are_named_and_ordered():
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None


def test_against_plain_version(run):
    spark, sf_dir, got = run
    rows = [r[:5] for r in documents()]
    model = langid.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    told = model.predict([t for _, t, *_ in rows])
    assert [p for (p, _), (_, t, *_) in zip(told, rows) if p == "und"] and all((p == "und") == (not re.search(r"[^\W\d_]", t or "")) for (p, _), (_, t, *_) in zip(told, rows))
    rows = [r for r, (p, _) in zip(rows, told) if p != "und"]
    groups = dict(exact([(i, t) for i, t, *_ in rows]))
    rows = [r for r in rows if groups[r[0]] == r[0]]
    assert not {301, 302} & {r[0] for r in rows}
    rows = mixed(cut(rows))
    library = Tokenizer.from_file(tokenizer_path())
    want = sorted((i, lang or "", s or "", library.encode(t, add_special_tokens=False).ids) for i, t, lang, s, _ in rows)
    assert sorted((r.doc_id, r.lang or "", r.source or "", r.ids) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_stages_return_the_columns_of_documents(run):
    spark, sf_dir, _ = run
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == list(P.COLUMNS)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_stages_take_odd_rows(spark, tmp_path):
    """Null ids, null, empty and blank texts, repeated rows, one id with two texts, columns that clash with those made inside."""
    long_ = " ".join(f"w{k}" for k in range(80))
    rows = [(1, long_, "en", "a"), (1, long_, "en", "a"), (1, "another text of this id", "en", "a"), (2, long_ + " end", "en", None), (None, long_, None, "b"), (None, None, None, None), (3, None, "en", "a"), (4, "", "en", "b"), (5, "  \n", "en", "b"), (6, "few words", None, "a")]
    schema = P.COLUMNS[0] + " long, text string, lang string, source string, n_chars long, node long, place string, id string, copies int, spans string"
    docs = spark.createDataFrame([(i, t, lang, s, len(t or ""), 7, "x", "y", 9, "z") for i, t, lang, s in rows], schema)
    key = lambda rs: sorted(((r.doc_id, r.text) for r in rs), key=str)
    stages = {name: stage(spark, docs, str(tmp_path)) for name, stage in P.STAGES if name != "language identification"}
    assert all(df.columns == list(P.COLUMNS) for name, df in stages.items() if name != "BPE encoding")
    # the smallest id of a group stays, as often as it came, and so do null ids; texts without words are one group
    assert key(stages["SimHash near-dedup"].collect()) == key(docs.where("doc_id is null or doc_id in (1, 3, 6)").collect())
    # a null id comes first, repeated rows are one place, and what is left of no text goes
    left = stages["suffix-array dedup"].collect()
    assert all(r.n_chars == len(r.text) for r in left) and {r.doc_id for r in left} == {None, 1, 2, 6, 5}
    assert [r.text for r in left if r.doc_id is None] == [long_] and [r.text for r in left if r.doc_id == 2][0].endswith(" end") and len([r.text for r in left if r.doc_id == 2][0]) < 200
    mixed = stages["mixing sources"].collect()
    assert {(r.doc_id, r.text) for r in mixed} <= {(i, t) for i, t, *_ in rows} and max(sum((r.doc_id, r.text) == (2, long_ + " end") for r in mixed), 1) <= 2
    ids = stages["BPE encoding"].collect()
    assert len(ids) == len(rows) and sum(not r.ids for r in ids) == 3 and all(r.n_tokens == len(r.ids) for r in ids)
    for _, stage in P.STAGES[1:]:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
