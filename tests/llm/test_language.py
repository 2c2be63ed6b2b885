"""Language identification against a plain version, on odd rows and by its held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmill.llm import language
from starmill.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, score string, held_out int, n_words string"


def plain(rows, how):
    """(doc_id, lang, cost by language) by the method, word by word, without a bound on the model."""
    split = lambda t: [w for w in re.findall(r"[^\W\d_]+", (t or "").lower())]
    learnt = [r for r in rows if r[0] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    words, grams = {}, {}
    for _, text, lang in learnt:
        for w in split(text):
            words.setdefault(lang, Counter())[w] += 1
    for lang, counted in words.items():
        for w, k in counted.items():
            for n in range(1, how.longest + 1):
                for g in language.grams_of(w, n):
                    if g != " ":
                        grams.setdefault((lang, n), Counter())[g] += k
    langs = sorted(words)

    def costs(tables, token):
        found = [tables.get(x, {}).get(token) for x in langs if True]
        return [min(how.penalty, -math.log(c / sum(tables[x].values()))) if c else how.penalty for x, c in zip(langs, found, strict=True)], any(found)

    def cost(w):
        value, known = costs(words, w)
        if known:
            return value
        for n in range(min(how.longest, len(w) + 2), 0, -1):
            each = [costs({x: grams.get((x, n), {}) for x in langs}, g) for g in language.grams_of(w, n)]
            each = [v for v, known in each if known]
            if each:
                return [sum(c) / len(each) for c in zip(*each, strict=True)]
        return [how.penalty] * len(langs)

    out = []
    for doc_id, text, _ in rows:
        each = [cost(w) for w in split(text)]
        mean = [sum(c) / len(each) for c in zip(*each, strict=True)] if each and langs else None
        out.append((doc_id, langs[mean.index(min(mean))] if mean else "und", mean))
    return out


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_split_words():
    words, owners = language.split_words(pa.array(["Ab1c d_e", None, "", "éÀ -- Straße 12", "́ x́y", "नमस्ते"]))
    assert words.to_pylist() == ["ab", "c", "d", "e", "éà", "straße", "x́y", "नमस्ते"]
    assert list(owners) == [0, 0, 0, 0, 3, 3, 4, 5]


def test_against_the_plain_version(spark, documents):
    how = language.WordFirst()
    rows = [(r.doc_id, r.text, r.lang) for r in documents.collect()]
    got = {r.doc_id: r for r in language.language_report(documents, how).collect()}
    for doc_id, lang, mean in plain(rows, how):
        assert got[doc_id].lang_pred == lang
        assert got[doc_id].score == pytest.approx(1 / sum(math.exp(min(mean) - m) for m in mean), rel=1e-4)


def test_unseen_words_fall_back_to_shorter_grams():
    rows = {"the": 0, "\0the": 1, "\0z": 2, "\0 t": 3}
    model = language.LanguageModel(["a", "b"], rows, language.np.array([[1, 15], [15, 2], [3, 15], [15, 4]], "f4"))
    costs = language._Costs(model, language.WordFirst(longest=3))
    at = costs.numbers(["the", "xthex", "tz", "zq", "qq"])
    assert at[0] == 0 and (at[1:] >= 4).all()
    assert costs.of(at).tolist() == [[1, 15], [15, 2], [15, 4], [3, 15], [15, 15]]
    assert (costs.numbers(["tz", "qq"]) == at[[2, 4]]).all()
    costs.how = language.WordFirst(remembered=1)
    assert (costs.numbers(["qq"]) == 4).all() and costs.of(language.np.array([4])).tolist() == [[15, 15]]


def test_odd_rows(spark, documents):
    english = [(i, "the man and the dog of the house", "en", "x", 0, None) for i in range(40)]
    french = [(100 + i, "le chien et la maison de la rue", "fr", "x", 0, None) for i in range(40)]
    odd = [(900, None, "en", None, 1, ""), (901, "", "en", None, 1, ""), (902, "12 -- ́!", "en", None, 1, ""), (None, "the dog", "xx", None, 1, ""),
           (903, "la rue " * 100_000, None, None, 1, ""), (904, "the dog", "en", None, 1, ""), (904, "the dog", "en", None, 1, "")]
    df = spark.createDataFrame([*english, *french, *odd], SCHEMA)
    got = language.language_report(df).collect()
    assert len(got) == len(english) + len(french) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (0, 100, 900, 901, 902, None, 903, 904)] == ["en", "fr", "und", "und", "und", "en", "fr", "en"]
    assert (by[900].score, by[902].n_words, by[903].n_words, by[None].held_out) == (0.0, 0, 200_000, False)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert len([r for r in got if r.doc_id == 904]) == 2
    # held-out rows, and rows without a language, teach nothing
    kept = {r.doc_id for r in got if r.held_out}
    only = df.where(F.col("doc_id").isin([i for i in kept if i is not None]))
    assert {r.lang_pred for r in language.language_report(only).collect()} == {"und"}
    assert language.language_report(df.limit(0)).count() == 0


def test_the_model_is_bounded(documents):
    how = language.WordFirst(words=500, grams=300)
    model = language.learn(documents, how)
    words = [t for t in model.rows if t[0] != "\0"]
    assert 0 < len(words) <= 500 and 0 < len(model.rows) - len(words) <= 300
    # every language keeps its own commonest words
    assert {"the", "der", "que", "les"} <= set(words)


def test_held_out_accuracy(spark):
    got = QUERIES["op11_language"](spark, "/root/testdata/sf0.01").where("held_out")
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    hits, n = got.join(known, "doc_id").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 300 and hits >= 0.98 * n
