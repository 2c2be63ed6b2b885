"""The manifest against a plain tree, on the whole smallest tables and on odd rows."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from starmill.llm import merkle
from starmill.llm.queries import QUERIES

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, root int, grp string, pos bigint"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], text)])


def tree(nodes, fan):
    """The root, and for every node what stands beside its way, as (before, after) for each level."""
    ways = [[] for _ in nodes]
    level, owners = nodes, [[i] for i in range(len(nodes))]
    while len(level) > 1:
        above, of = [], []
        for s in range(0, len(level), fan):
            run = level[s : s + fan]
            for k in range(len(run)):
                for i in owners[s + k]:
                    ways[i].append((run[:k], run[k + 1 :]))
            above.append(H(*run))
            of.append([i for o in owners[s : s + fan] for i in o])
        level, owners = above, of
    return level[0], ways


def plain(rows, fan=16, every=5):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted tuples of the contract."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    parts = {}
    for s in sources:
        ordered = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        parts[s] = (ordered, *tree([leaf(r, r[4]) for r in ordered], fan))
    root, over = tree([parts[s][1] for s in sources], fan) if sources else (None, [])
    out = []
    for s, up in zip(sources, over, strict=True):
        ordered, subroot, ways = parts[s]
        for r, way in zip(ordered, ways, strict=True):
            own = leaf(r, r[4])
            node = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0:
                node = leaf(r, None if r[4] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]))
            for before, after in way + up:
                node = H(*before, node, *after)
            proof = H(*[d for before, after in way + up for d in before + after])
            out.append((r[0], own, subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def given(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_the_plain_tree(spark, sf):
    got = QUERIES["op12_merkle"](spark, f"/root/testdata/{sf}")
    want = plain(rows_of(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")))
    assert given(got) == want
    assert {v for *_, v in want} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [2], [9], [81], [82], [730, 1, 9, 80, 81, 3], [1] * 30, [10] * 100, [9] * 9 + [1]])
def test_small_fans_make_deep_trees(spark, sizes):
    """Blocks of 9 nodes: groups that end in the middle and at the edge of blocks, on every level."""
    rng = random.Random(sum(sizes))
    rows = [(i * 7 + s, f"s{s}", "en", i, rng.choice("aBé")) for s, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1, "g", 5) for r in rows], SCHEMA).repartition(3)
    assert given(merkle.manifest(df, merkle.Tree(fan=3, every=2))) == plain(rows, 3, 2)


def test_odd_rows(spark):
    rows = [(1, None, "en", 3, "ABC"), (None, "s", None, None, None), (None, "s", "de", 1, "É"), (2, "", "en", 0, ""), (5, "é", "en", 1, "😀" * 1_000_000 + "A"),
            (7, "z", "en", 1, "same"), (7, "z", "en", 1, "same"), (7, "z", "en", 2, "other"), (8, "Z", "e:1", -3, "-"), (-9, "z", "en", 1, "X")]
    rows += [(7, "z", "en", 1, "same")] * 60
    df = spark.createDataFrame([(*r, "x", 1, "g", 5) for r in rows], SCHEMA)
    assert given(merkle.manifest(df)) == plain(rows)
    assert merkle.manifest(df.limit(0)).count() == 0
    one = merkle.manifest(df.where("doc_id = 1")).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == H("")


def test_versions_share_what_they_do_not_copy(spark):
    """A version holds the path to its root alone: the tree with one leaf exchanged, built anew, has just these other nodes."""
    rows = [(i, f"s{i % 3}", "en", 1, f"Text {i}") for i in range(60)]
    df = spark.createDataFrame([(*r, "x", 1, "g", 5) for r in rows], SCHEMA)
    found = {r.doc_id: r for r in merkle.manifest(df, merkle.Tree(fan=4, every=3)).collect()}
    tampered = [i for i in found if found[i].tampered]
    assert tampered and all(len(r.version) == 4 for r in found.values())  # 20 leaves, 5, 2, 1; then 3 subroots, 1
    for i in tampered[:5]:
        again = [(*r[:4], r[4].lower()) if r[0] == i else r for r in rows]
        fresh = {r.doc_id: r for r in merkle.manifest(spark.createDataFrame([(*r, "x", 1, "g", 5) for r in again], SCHEMA), merkle.Tree(fan=4, every=3)).collect()}
        assert fresh[i].root == found[i].version[-1] == found[i].folded_root and fresh[i].subroot == found[i].version[-2]
        others = {r.subroot for r in found.values() if r.source != found[i].source}
        assert others == {r.subroot for r in fresh.values() if r.source != found[i].source}


def test_positions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "c"] + ["hot"] * 9), rng.choice([None, 1, 2, 3, 4])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int").repartition(5)
    got = defaultdict(list)
    for r in merkle.numbered(df, "g", ["o"], "test").collect():
        got[r.g].append((r.pos, r.o))
    assert sum(map(len, got.values())) == 3000
    for g, found in got.items():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        assert [o for _, o in found] == sorted((o for h, o in rows if h == g), key=lambda o: (o is not None, o or 0))
    assert merkle.numbered(df.where(F.lit(False)), "g", ["o"], "test").count() == 0
