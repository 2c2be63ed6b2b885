"""Each stage of the pipeline, and the queries that SQL can't say, against plain versions over whole tables."""

import math
from bisect import bisect_right
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from starmill.llm import pii, quality
from starmill.llm.queries import QUERIES, tokenizer_path
from starmill.session import written

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
ODD = [(None, "a text that nobody has a number for " * 30, "en", "s", None), (9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, " \n\t", "en", "s", 3)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    return {(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark, documents):
    """The documents, some twice, and rows with nulls and nothing in them."""
    more = spark.createDataFrame(ODD, documents.schema).unionByName(documents.where("doc_id % 50 = 0"))
    return written(documents.unionByName(more), "odd-documents")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_scores(texts, labels):
    """id -> score: the model's tables looked up one feature at a time."""
    import zlib

    kinds, how = quality._byte_classes(), quality.Training()
    features = lambda t: quality.features_of((t or "").encode(), kinds)
    learnt = sorted((str(i), q, features(texts[i])) for i, q in labels if i in texts and q in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2)
    model = quality.fit(np.array([x for _, _, x in learnt]), np.array([float(q) for _, q, _ in learnt]), how)
    out = {}
    for i, text in texts.items():
        x = features(text)
        raw = model.base + sum(table[bisect_right(list(model.edges[j]), x[j])] for j, table in enumerate(model.tables))
        raw += sum(table[bisect_right(list(model.pair_edges[a]), x[a]), bisect_right(list(model.pair_edges[b]), x[b])] for (a, b), table in model.pair_tables.items())
        out[i] = 1 / (1 + math.exp(-max(-30, min(30, raw))))
    return out


def test_quality_query_and_stage(spark, documents, labels, odd):
    texts = {r.doc_id: r.text for r in documents.collect()}
    want = plain_scores(texts, labels)
    got = {r.doc_id: r for r in QUERIES["op8_quality"](spark, SF_DIR).collect()}
    assert set(got) == set(want)
    assert all(abs(got[i].score - want[i]) < 1e-9 and got[i].predicted == (want[i] >= 0.7) for i in want)
    kept = STAGES["quality"](spark, documents, SF_DIR)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert rows(kept) == rows(documents.where(documents.doc_id.isin([i for i in want if want[i] >= 0.7])))
    again = STAGES["quality"](spark, odd, SF_DIR).collect()
    assert {r.doc_id for r in again} >= {i for i in want if want[i] >= 0.7 and i % 50 == 0}


def test_near_duplicate_stage(spark, documents, odd):
    want = brute.components([(r.doc_id, r.text) for r in documents.collect()])
    kept = STAGES["near-duplicates"](spark, odd, SF_DIR)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    # repeated rows go, rows without a word or a number stay
    unique = documents.where(documents.doc_id.isin([i for i, (_, c) in want.items() if i == c]))
    assert rows(kept) == rows(unique.unionByName(spark.createDataFrame(ODD, documents.schema)))


def test_decontamination_stage(spark, documents, odd):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    held = odd.collect()
    found = brute.contamination([r.text for r in held], items)
    kept = STAGES["decontamination"](spark, odd, SF_DIR)
    assert rows(kept) == sorted((tuple(r) for r, f in zip(held, found, strict=True) if not f[-1]), key=repr)


def test_personal_data_stage(spark, documents, odd):
    before = defaultdict(list)
    for r in odd.collect():
        before[r.doc_id].append(r)
    masked = STAGES["personal data"](spark, odd, SF_DIR).collect()
    assert len(masked) == sum(map(len, before.values()))
    for r in masked:
        was = before[r.doc_id][0]
        assert (r.lang, r.source) == (was.lang, was.source)
        spans = brute.base_spans(was.text)
        if not spans:
            continue
        # no e-mail address is left as it was, and what lies outside all findings is
        assert all(was.text[s:e] not in r.text for k, s, e in spans if k == "email")
        assert r.text != was.text
    assert pii.mask(odd.limit(0)).count() == 0


def check_packing(pieces, texts, ids_column):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, found in by_doc.items():
        ids, crc = brute.pieces(texts[i], tokenizer)
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r[ids_column]) == (at, len(ids), crc(r.start, r.length))
            assert r.length & (r.length - 1) == 0 and r.length <= 2048
            at += r.length
        assert at == len(ids)
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len({r.length for r in found}) == 1


def test_packing_query_and_stage(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    check_packing(QUERIES["op7_packing"](spark, SF_DIR).collect(), texts, "ids_crc32")
    check_packing(STAGES["packing"](spark, documents, SF_DIR).collect(), texts, "ids_crc32")


def test_run_is_its_stages_one_after_the_other(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), f"test-{name.replace(' ', '-')}")
    drop = ["sequence_id", "offset"]  # which sequence a piece is in may differ from run to run
    assert rows(corpus_pipeline.run(spark, SF_DIR).drop(*drop)) == rows(docs.drop(*drop))


@pytest.mark.parametrize("name", list(STAGES))
def test_no_documents(spark, documents, name):
    assert STAGES[name](spark, documents.limit(0), SF_DIR).count() == 0


def test_extraction_over_the_whole_table(spark):
    """The given pages hold one article each; a plain reader takes its blocks."""
    import html as entities
    import re

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op6_extract"](spark, SF_DIR).collect()}
    assert set(got) == {r.page_id for r in pages}
    agreed = 0
    for page in pages:
        inner = re.search(r"<article[^>]*>(.*?)</article>", page.html or "", re.S)
        body = re.sub(r"<(script|style|aside|form)\b.*?</\1>|<!--.*?-->", " ", inner[1] if inner else "", flags=re.S)
        plain = " ".join(entities.unescape(re.sub(r"<[^>]+>", " ", body)).split())
        mine = " ".join(got[page.page_id].text.split())
        assert got[page.page_id].n_chars == len(got[page.page_id].text)
        agreed += re.sub(r"\s", "", plain) == re.sub(r"\s", "", mine)
    assert agreed >= 0.9 * len(pages)
