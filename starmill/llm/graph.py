"""Connected components by alternating large-star and small-star steps, and links found in buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import fitting, written


def _with_least(sides: DataFrame) -> DataFrame:
    """Adds to every (u, v) the smallest of u's neighbours and u itself."""
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return sides.join(least, "u")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    sides = _with_least(_both_ways(edges))
    return sides.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    tied = _with_least(down)
    pairs = tied.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
    return pairs.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of the edges (u, v), u > v, has one edge to a smaller node and none to a larger one, or only the latter."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger")))
    ends = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return ends.where("smaller + larger > 1").isEmpty()


def connected_components(links: DataFrame, longest: int = 100) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (u, v); links to oneself say nothing.

    Each round is written to the shared folder, so that no round repeats the
    ones before it. The rounds needed grow with the logarithm of the nodes;
    links that are stars need none.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    edges = written(edges.distinct(), "links")
    for _ in range(longest):
        if _are_stars(edges):
            break
        edges = written(_small_star(_large_star(edges)), "stars")
    else:
        raise RuntimeError(f"no stars after {longest} rounds")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ends.unionByName(roots)


def with_links(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (node, component) once they are joined by ``links`` (u, v) as well.

    The links between components are what goes through the rounds, however
    large the components are: a component's name is its smallest node, and that
    of joined ones the smallest of their names.
    """
    named = fitting(written(groups, "groups"))
    side = lambda x: named.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
    between = links.join(side("u"), "u", "left").join(side("v"), "v", "left")
    between = between.select(F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v"))
    joined = fitting(written(connected_components(between), "joined-components"))
    into = joined.select(F.col("node").alias("component"), F.col("component").alias("into"))
    before = named.join(into, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    # a node that has been alone so far is its own name
    return written(before.unionByName(joined.join(named.select("node"), "node", "left_anti").select("node", "component")), "groups-joined")


def link_buckets(
    members: DataFrame,
    likely: Callable[[DataFrame], DataFrame],
    confirm: Callable[[DataFrame], DataFrame],
    weigh: Callable[[DataFrame], DataFrame] | None = None,
    can_link: Callable[[str, str], Column] | None = None,
) -> DataFrame:
    """node, component of all nodes that are linked, given ``members`` (doc_id, bucket).

    Two nodes that share a bucket are linked if ``likely`` keeps their pair
    (a, b), a < b, and ``confirm`` returns it as (u, v). No bucket's pairs are
    listed: all its nodes are compared with its smallest, each with the smallest
    of its likely partners first and with the others only where that has left
    them apart. A link inside a component can't change it, so that the buckets
    compared further are those of three nodes or more that still lie in several
    components, and the pairs those between them. Which is every pair that can
    matter, without a cap. Before that, such a bucket's nodes are compared once
    more with one of them, picked by hash, so that components with many links
    between them are joined by few. ``weigh`` may give columns for those nodes
    (doc_id) from which ``can_link`` tells that a pair can't be a link; it gets
    the aliases of the two sides. What it lets through is all that is listed.
    """
    buckets = members.groupBy("bucket").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"))
    buckets = written(buckets.where("least < most").select("bucket", "least", "n"), "buckets")
    to_least = members.join(fitting(buckets), "bucket").where("doc_id > least").select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = written(likely(to_least), "star-pairs")
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    groups = connected_components(written(confirm(first), "links-first"))
    more = written(_across(stars.join(first, ["a", "b"], "left_anti"), groups), "more-pairs")
    if not more.isEmpty():
        groups = with_links(groups, written(confirm(more), "links-more"))

    shared = members.join(fitting(buckets.where("n > 2").select("bucket")), "bucket")
    shared = written(_mixed(shared, groups), "mixed-buckets")
    hub = F.min_by(F.struct("doc_id", "component"), F.xxhash64("doc_id", "bucket")).alias("hub")
    apart = F.col("hub.component") != F.col("component")
    hubs = shared.join(shared.groupBy("bucket").agg(hub), "bucket").where(apart)
    to_hub = hubs.select(F.least("doc_id", "hub.doc_id").alias("a"), F.greatest("doc_id", "hub.doc_id").alias("b")).distinct()
    more = written(confirm(written(likely(to_hub.join(stars, ["a", "b"], "left_anti")), "hub-pairs")), "links-hubs")
    if not more.isEmpty():
        groups = with_links(groups, more)
        # a component's name is one of its nodes, so it is what has to be looked up: once for a bucket, and for members only where a bucket is still mixed
        joined = fitting(written(groups.select(F.col("node").alias("component"), F.col("component").alias("into")), "joined-components"))
        renamed = lambda df, *columns: df.join(joined, "component", "left").select(*columns, F.coalesce("into", "component").alias("component"))
        still = renamed(shared.select("bucket", "component").distinct(), "bucket")
        shared = renamed(shared.join(_mixed_ids(still), "bucket"), "bucket", "doc_id")
    nodes = written(shared.groupBy("doc_id", "component").agg(F.collect_set("bucket").alias("buckets")), "mixed-members")
    if nodes.isEmpty():
        return written(groups, "components")
    if weigh is not None:
        nodes = written(nodes.join(fitting(written(weigh(nodes.select("doc_id")), "weights")), "doc_id"), "weighed-members")
    each = nodes.withColumn("bucket", F.explode("buckets"))
    apart = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.doc_id") < F.col("y.doc_id"))
    if can_link is not None:
        apart &= can_link("x", "y")
    # a pair that meets in several buckets is taken from one
    apart &= F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket")
    rest = each.alias("x").join(each.alias("y"), apart).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
    rest = rest.join(stars, ["a", "b"], "left_anti")
    last = written(confirm(written(likely(rest), "rest-pairs")), "links-last")
    return with_links(groups, last)


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends are in different components so far."""
    ends = fitting(written(groups, "groups"))
    side = lambda x: ends.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _mixed(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The members (doc_id, bucket, component) of buckets that lie in several components."""
    ends = fitting(written(groups.withColumnRenamed("node", "doc_id"), "groups"))
    return _in_mixed_buckets(members.join(ends, "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")))


def _mixed_ids(named: DataFrame) -> DataFrame:
    """The buckets of (bucket, component) that lie in several components."""
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    return fitting(written(mixed, "mixed-bucket-ids"))


def _in_mixed_buckets(named: DataFrame) -> DataFrame:
    return named.join(_mixed_ids(named), "bucket")
