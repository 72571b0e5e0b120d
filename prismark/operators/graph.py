"""Co-author graph as node and edge tables.

Edges are author pairs by position inside an article, weighted by the number
of articles (a repeated author in one article gives a self-loop, as the
reference's graph does).  Pair generation is salted: an article with ``n``
authors is split into ``ceil(n / block)`` slices of the left side, each
joined to the whole author list of that article, so a hyper-authored article
is spread over many tasks instead of producing its ``n^2/2`` pairs in one.
Weights are then summed with a partial aggregate.

Communities (N5) are an iterative approximation of greedy modularity: each
round every community picks its best neighbour, and pairs that picked each
other with a positive gain merge.  Lineage is cut every round with a reliable
checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from prismark.operators.biblio import author_list
from prismark.operators.ranking import top_k_per_group
from prismark.session import cut_lineage


def author_positions(df: DataFrame, id_col: str, authors_col: str, trim: bool = True) -> DataFrame:
    """``(doc, pos, author, n)`` from a ``;``-separated author string (trap T7: ``trim``)."""
    lst = author_list(authors_col, ";", trim)
    return df.select(F.col(id_col).alias("doc"), lst.alias("_a")).select(
        "doc", F.posexplode("_a").alias("pos", "author"), F.size("_a").alias("n")
    )


def coauthor_nodes(positions: DataFrame) -> DataFrame:
    """``(author, publications)``; an author listed twice counts twice."""
    return positions.groupBy("author").agg(F.count(F.lit(1)).alias("publications"))


def coauthor_edges(positions: DataFrame, block: int = 64) -> DataFrame:
    """``(a, b, weight)`` with ``a <= b``; pairs by position, salted per article."""
    salts = F.greatest(F.ceil(F.col("n") / F.lit(block)), F.lit(1)).cast("int")
    left = positions.select(
        "doc", F.col("pos").alias("pl"), F.col("author").alias("al"), (F.col("pos") % salts).alias("salt")
    )
    right = positions.select(
        "doc", F.col("pos").alias("pr"), F.col("author").alias("ar"),
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
    )
    pairs = left.join(right, ["doc", "salt"]).where(F.col("pl") < F.col("pr"))
    return pairs.groupBy(F.least("al", "ar").alias("a"), F.greatest("al", "ar").alias("b")).agg(
        F.count(F.lit(1)).alias("weight")
    )


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node count, edge count (self-loops included), density ``2m / (n(n-1))``."""
    n = nodes.agg(F.count(F.lit(1))).scalar()
    return edges.agg(F.count(F.lit(1)).alias("edges")).select(
        n.alias("nodes"),
        "edges",
        F.when(n > 1, F.round(F.col("edges") * 2.0 / (n * (n - 1)), 6)).otherwise(F.lit(0.0)).alias("density"),
    )


def top_nodes(nodes: DataFrame, k: int = 30) -> DataFrame:
    """Most published authors, ties by name."""
    return nodes.orderBy(F.desc("publications"), F.asc("author")).limit(k)


def induced_subgraph(edges: DataFrame, keep: DataFrame) -> DataFrame:
    """Edges whose both ends are in ``keep`` (semi joins; Catalyst broadcasts a small list)."""
    k = keep.select(F.col("author").alias("_n"))
    return edges.join(k, edges["a"] == k["_n"], "left_semi").join(
        k.withColumnRenamed("_n", "_m"), edges["b"] == F.col("_m"), "left_semi"
    )


def _degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node")))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("deg"))


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Unweighted modularity of a partition ``labels(node, community)``.

    ``Q = sum_c L_c / m - (D_c / 2m)^2``; each edge counts once, a self-loop
    adds 2 to its node's degree.
    """
    m = edges.agg(F.count(F.lit(1))).scalar()
    lab = labels.select(F.col("node"), F.col("community"))
    la = lab.withColumnRenamed("node", "a").withColumnRenamed("community", "ca")
    lb = lab.withColumnRenamed("node", "b").withColumnRenamed("community", "cb")
    internal = (
        edges.join(la, "a").join(lb, "b").where(F.col("ca") == F.col("cb"))
        .groupBy(F.col("ca").alias("community")).agg(F.count(F.lit(1)).alias("l_c"))
    )
    deg = _degrees(edges).join(lab, "node").groupBy("community").agg(F.sum("deg").alias("d_c"))
    per = deg.join(internal, "community", "left").select(
        (F.coalesce(F.col("l_c"), F.lit(0)) / m - F.pow(F.col("d_c") / (2.0 * m), 2)).alias("q")
    )
    return per.agg(F.round(F.sum("q"), 6).alias("modularity"))


def communities(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``(node, community)`` by rounds of star merges on modularity gain (unweighted).

    Gain of merging c and d: ``e_cd / m - D_c * D_d / (2 m^2)`` where ``e_cd``
    counts edges between them (self-loops count in degrees only).  Each round
    every community picks its best neighbour with a positive gain (ties to the
    smallest id).  A picked community is a *hub* when it picks no one itself,
    or when it and its pick chose each other and it has the smaller id; every
    community whose pick is a hub moves into it.  Non-hubs that picked a
    non-hub wait for a later round.  A community id is a node name in it.

    This merges whole stars per round (a dense graph needs one round, not one
    per pair) and runs until no merge gains (the best pair always chooses each
    other, so every round merges); the result can differ from one-pair-at-a-time greedy merging and
    is compared by modularity (N6).  Inputs and each round's labels are
    checkpointed (reliable, shared folder).  ``nodes`` (a one-column table) adds
    nodes without edges, each a community of its own.
    """
    # The input is computed once and checkpointed: every round reads it again.
    und = cut_lineage(edges.select("a", "b"))
    deg = cut_lineage(_degrees(und))
    m = F.lit(und.count())
    every = deg.select("node")
    if nodes is not None:
        every = every.unionByName(nodes.select(F.col(nodes.columns[0]).alias("node"))).distinct()
    labels = cut_lineage(every.select("node", F.col("node").alias("community")))
    while True:
        la = labels.withColumnRenamed("node", "a").withColumnRenamed("community", "ca")
        lb = labels.withColumnRenamed("node", "b").withColumnRenamed("community", "cb")
        ce = und.join(la, "a").join(lb, "b").where(F.col("ca") != F.col("cb"))
        pair = ce.select(F.least("ca", "cb").alias("c"), F.greatest("ca", "cb").alias("d"))
        e = pair.groupBy("c", "d").agg(F.count(F.lit(1)).alias("e"))
        dc = deg.join(labels, "node").groupBy("community").agg(F.sum("deg").alias("D"))
        both = e.unionByName(e.select(F.col("d").alias("c"), F.col("c").alias("d"), "e"))
        gains = (
            both.join(dc.select(F.col("community").alias("c"), F.col("D").alias("Dc")), "c")
            .join(dc.select(F.col("community").alias("d"), F.col("D").alias("Dd")), "d")
            .select("c", "d", (F.col("e") / m - F.col("Dc") * F.col("Dd") / (2.0 * m * m)).alias("gain"))
        )
        best = top_k_per_group(gains, ["c"], [F.desc("gain"), F.asc("d")], 1).where(F.col("gain") > 0).select("c", "d")
        best = cut_lineage(best)
        if best.isEmpty():
            return labels
        choosers = best.select(F.col("c").alias("h"))
        mutual_low = best.alias("x").join(
            best.alias("y"), (F.col("x.c") == F.col("y.d")) & (F.col("x.d") == F.col("y.c")) & (F.col("x.c") < F.col("x.d"))
        ).select(F.col("x.c").alias("h"))
        targets = best.select(F.col("d").alias("h")).distinct()
        hubs = targets.join(choosers, "h", "left_anti").unionByName(targets.join(mutual_low, "h", "left_semi"))
        moves = best.join(hubs.withColumnRenamed("h", "d"), "d", "left_semi").join(
            hubs.withColumnRenamed("h", "c"), "c", "left_anti"
        ).select(F.col("c").alias("community"), F.col("d").alias("merged"))
        labels = cut_lineage(
            labels.join(moves, "community", "left").select("node", F.coalesce("merged", "community").alias("community"))
        )


def community_members(labels: DataFrame) -> DataFrame:
    """N7 in long form: ``(community, size, node)``, largest community first.

    One row per node and a distributed sort; no community is collected into
    a single row.
    """
    sizes = labels.groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    return labels.join(sizes, "community").select("community", "size", "node").orderBy(
        F.desc("size"), F.asc("community"), F.asc("node")
    )


def community_invariants(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``n_nodes, repeated, wrong_sizes, gains`` of a partition: nodes, rows beyond one a node, listed sizes that are not
    the number of rows, and whether its modularity is at least that of all nodes in one community, which is 0."""
    members = community_members(labels)
    wrong = members.groupBy("community").agg(F.count(F.lit(1)).alias("k"), F.min("size").alias("lo"), F.max("size").alias("hi"))
    got = modularity(edges, labels).agg(F.max("modularity")).scalar()
    return members.agg(
        F.count_distinct("node").alias("n_nodes"), (F.count(F.lit(1)) - F.count_distinct("node")).alias("repeated")
    ).select(
        "n_nodes", "repeated", wrong.agg(F.count_if((F.col("k") != F.col("lo")) | (F.col("k") != F.col("hi")))).scalar().alias("wrong_sizes"),
        F.coalesce(got >= 0, F.lit(True)).alias("gains"),
    )


def positions_from_rows(df: DataFrame, doc_col: str, pos_col: str, author_col: str) -> DataFrame:
    """``(doc, pos, author, n)`` from one-row-per-author tables (``n`` = authors of the doc)."""
    p = df.select(
        F.col(doc_col).alias("doc"), F.col(pos_col).alias("pos"), F.col(author_col).cast("string").alias("author")
    )
    n = p.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    return p.join(n, "doc")


def author_concentration(positions: DataFrame, authors: DataFrame | Iterable[str], n_articles: Column) -> DataFrame:
    """Number and share of all articles that list any of ``authors``.

    ``authors`` is a name list or a one-column table of names (semi join).
    """
    if isinstance(authors, DataFrame):
        sel = positions.join(authors.select(F.col(authors.columns[0]).alias("author")), "author", "left_semi")
    else:
        sel = positions.where(F.col("author").isin(*list(authors)))
    hits = sel.agg(F.count_distinct("doc").alias("n"))
    return hits.select("n", F.round(F.col("n") * 100.0 / n_articles, 6).alias("pct"))
