"""Co-occurrence graph of names and its metrics. Iterations are cut to the shared folder; nothing collects the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layoutgraph.operators import cooccur
from layoutgraph.operators.components import components
from layoutgraph.plans.session import cut


def edges(members: DataFrame, min_weight: int = 1) -> DataFrame:
    """(a, b, weight), a < b: number of shared chunks, from distinct (basket, item)."""
    return cooccur.pair_counts(members, 1, min_count=min_weight).select("a", "b", F.col("n_ab").alias("weight"))


def isolates(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes (item) without any edge."""
    ends = links.select(F.col("a").alias("item")).unionByName(links.select(F.col("b").alias("item"))).distinct()
    return nodes.join(ends, "item", "left_anti")


def both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b", "weight").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))


def degrees(links: DataFrame) -> DataFrame:
    return both_ways(links).groupBy(F.col("a").alias("item")).agg(F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("strength"))


def density(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """One row: nodes, edges, density, mean degree (4 decimals), highest degree."""
    n = nodes.agg(F.countDistinct("item").alias("nodes"))
    e = links.agg(F.count(F.lit(1)).alias("edges"))
    top = degrees(links).agg(F.coalesce(F.max("degree"), F.lit(0)).alias("max_degree"))
    dens = F.when(F.col("nodes") > 1, 2 * F.col("edges") / (F.col("nodes") * (F.col("nodes") - 1))).otherwise(F.lit(0.0))
    return n.crossJoin(e).crossJoin(top).select("nodes", "edges", F.round(dens, 4).alias("density"), F.round(F.when(F.col("nodes") > 0, 2 * F.col("edges") / F.col("nodes")).otherwise(0.0), 4).alias("mean_degree"), "max_degree")


def connected(links: DataFrame) -> DataFrame:
    """(item, component): the least name of the component of every node with an edge."""
    nodes = both_ways(links).select(F.col("a").alias("id")).distinct()
    return components(nodes, links).select(F.col("id").alias("item"), F.col("cls").alias("component"))


def pagerank(links: DataFrame, rounds: int = 100, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(item, rank) by weighted iterations from equal ranks; nodes are those with an edge. Ends after ``rounds``, or when a
    round changes the ranks by less than ``tolerance`` a node in sum (looked at every fifth round; 0: never)."""
    arcs = both_ways(links)
    out = arcs.groupBy("a").agg(F.sum("weight").alias("out"))
    arcs = cut(arcs.join(out, "a").select("a", "b", (F.col("weight") / F.col("out")).alias("share")), "arcs")
    n = out.count()
    if not n:
        return arcs.select(F.col("a").alias("item"), F.lit(0.0).alias("rank"))
    ranks = out.select(F.col("a").alias("item"), F.lit(1.0 / n).alias("rank"))
    for k in range(rounds):
        flow = arcs.join(ranks.withColumnRenamed("item", "a"), "a").groupBy(F.col("b").alias("item")).agg(F.sum(F.col("share") * F.col("rank")).alias("got"))
        before, ranks = ranks, flow.select("item", (F.lit((1 - damping) / n) + damping * F.col("got")).alias("rank"))
        if k % 5 == 4:
            ranks = cut(ranks, "ranks")
            if tolerance and ranks.join(before.withColumnRenamed("rank", "old"), "item").agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] < tolerance * n:
                break
    return ranks


def top_ranked(ranks: DataFrame, k: int = 10, digits: int = 6) -> DataFrame:
    """The ``k`` nodes of highest rank, in order: (item, rank); equal ranks by name."""
    return ranks.select("item", F.round("rank", digits).alias("rank")).orderBy(F.desc("rank"), "item").limit(k)


def group_sizes(labels: DataFrame, label: str) -> DataFrame:
    """(label, size) of components or communities."""
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("size"))


def metrics(links: DataFrame) -> DataFrame:
    """One row on the graph of nodes with an edge: nodes, edges, density (4 decimals), mean degree (2), highest degree and the
    node that has it (least name), number of components and size of the largest; zeros and null without edges."""
    d = degrees(links)
    c = group_sizes(connected(links), "component").agg(F.count(F.lit(1)).alias("components"), F.coalesce(F.max("size"), F.lit(0)).alias("largest_component"))
    e = links.agg(F.count(F.lit(1)).alias("edges"))
    n = d.agg(F.count(F.lit(1)).alias("nodes"), F.coalesce(F.max("degree"), F.lit(0)).alias("max_degree"), F.min_by("item", F.struct(-F.col("degree"), "item")).alias("max_degree_node"))
    dens = F.when(F.col("nodes") > 1, 2 * F.col("edges") / (F.col("nodes") * (F.col("nodes") - 1))).otherwise(0.0)
    mean = F.when(F.col("nodes") > 0, 2 * F.col("edges") / F.col("nodes")).otherwise(0.0)
    return n.crossJoin(e).crossJoin(c).select("nodes", "edges", F.round(dens, 4).alias("density"), F.round(mean, 2).alias("mean_degree"), "max_degree", "max_degree_node", "components", "largest_component")  # three tables of one row


def modularity(links: DataFrame, labels: DataFrame) -> float:
    """Weighted modularity of ``labels`` (item, community) on the graph."""
    arcs = both_ways(links).join(labels.withColumnsRenamed({"item": "a", "community": "ca"}), "a").join(labels.withColumnsRenamed({"item": "b", "community": "cb"}), "b")
    total = arcs.agg(F.sum("weight")).first()[0]
    if not total:
        return 0.0
    per = arcs.groupBy("ca").agg(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("weight")).otherwise(0)).alias("w"), F.sum("weight").alias("k"))
    return per.agg(F.sum(F.col("w") / total - (F.col("k") / total) ** 2)).first()[0]


def louvain(links: DataFrame, levels: int = 10, rounds: int = 12) -> DataFrame:
    """(item, community) by modularity, level by level: nodes move to the neighbouring community that gains most, then each
    community becomes a node. A community is named after its least member.

    Moves are made in parallel, which could swap two nodes for ever; in a round only the nodes of one half, drawn by hash
    and round, may move, and only for a gain. A level ends when a full pair of halves moves nobody, and the whole when a
    level does. Deterministic; the result need not be that of a sequential pass.
    """
    arcs = cut(both_ways(links).withColumn("weight", F.col("weight").cast("double")), "arcs")
    total = arcs.agg(F.sum("weight")).first()[0]
    members = cut(arcs.select(F.col("a").alias("item")).distinct().withColumn("community", F.col("item")), "members")
    if not total:
        return members
    for _ in range(levels):
        strength = cut(arcs.groupBy("a").agg(F.sum("weight").alias("k")), "strength")
        state = cut(strength.select(F.col("a").alias("node"), F.col("a").alias("c"), "k"), "state")
        ever, still = False, 0
        for r in range(rounds):
            size = state.groupBy("c").agg(F.sum("k").alias("sum"))
            # the weight from each node to each community beside it, loops left out
            to = arcs.filter("a <> b").join(state.select(F.col("node").alias("b"), F.col("c").alias("to")), "b").groupBy("a", "to").agg(F.sum("weight").alias("w"))
            own = state.select(F.col("node").alias("a"), F.col("c").alias("own"), "k")
            near = own.join(to, "a").join(size.select(F.col("c").alias("to"), F.col("sum").alias("to_sum")), "to")
            rest = F.col("to_sum") - F.when(F.col("to") == F.col("own"), F.col("k")).otherwise(0.0)
            scored = near.withColumn("gain", F.round(F.col("w") - F.col("k") * rest / total, 9))
            best = scored.groupBy("a").agg(F.max(F.when(F.col("to") == F.col("own"), F.col("gain"))).alias("stay"), F.min(F.struct((-F.col("gain")).alias("g"), F.col("to"))).alias("m"))
            half = F.pmod(F.xxhash64("node", F.lit(r // 2)), F.lit(2)) == r % 2
            # alone, staying gains nothing
            goes = half & F.col("m").isNotNull() & (-F.col("m.g") > F.coalesce("stay", F.lit(0.0)) + 1e-9) & (F.col("m.to") != F.col("c"))
            step = cut(state.join(best.withColumnRenamed("a", "node"), "node", "left").select("node", F.when(goes, F.col("m.to")).otherwise(F.col("c")).alias("c"), "k", F.coalesce(goes, F.lit(False)).alias("moved")), "state")
            moved = not step.filter("moved").isEmpty()
            state = step.drop("moved")
            ever, still = ever or moved, 0 if moved else still + 1
            if still == 2:
                break
        if not ever:
            break
        named = cut(state.join(state.groupBy("c").agg(F.min("node").alias("name")), "c").select("node", "name"), "named")
        members = cut(members.join(named.withColumnsRenamed({"node": "community"}), "community").select("item", F.col("name").alias("community")), "members")
        a, b = named.withColumnsRenamed({"node": "a", "name": "na"}), named.withColumnsRenamed({"node": "b", "name": "nb"})
        arcs = cut(arcs.join(a, "a").join(b, "b").groupBy(F.col("na").alias("a"), F.col("nb").alias("b")).agg(F.sum("weight").alias("weight")), "arcs")
    least = members.groupBy("community").agg(F.min("item").alias("least"))
    return members.join(least, "community").select("item", F.col("least").alias("community"))


def entity_members(resolved: DataFrame) -> DataFrame:
    """(basket, item) of resolved entities and their chunks."""
    return cooccur.baskets(resolved.select("normalized", F.explode("chunk_ids").alias("c")), "c", "normalized")


def entity_nodes(resolved: DataFrame) -> DataFrame:
    """Nodes of the graph of resolved entities with their attributes."""
    listed = lambda c, n=None, sep=",": F.array_join(F.slice(c, 1, n) if n else F.col(c), sep)
    return resolved.select(
        F.col("normalized").alias("item"), F.col("text").alias("label"), "entity_type", "frequency", listed("source_docs").alias("source_docs"), listed("aliases", 5).alias("aliases"), F.substring("context", 1, 200).alias("context"), listed("engines").alias("engines"),
        listed("source_element_ids").alias("source_element_ids"), listed("related_element_ids").alias("related_element_ids"), F.array_join(F.transform("block_indices", lambda x: x.cast("string")), ",").alias("block_indices"), listed("section_titles", 5, " | ").alias("sections"),
        F.size("source_element_ids").alias("source_element_count"), F.size("related_element_ids").alias("related_element_count"),
    )


def edge_chunks(members: DataFrame, min_weight: int = 1) -> DataFrame:
    """(a, b, weight, chunks): edges with the sorted chunks they come from."""
    return cooccur.pair_counts(members, 1, min_count=min_weight, lists=True).select("a", "b", F.col("n_ab").alias("weight"), F.col("baskets").alias("chunks"))


def communities(links: DataFrame, rounds: int = 8) -> DataFrame:
    """(item, community): label propagation by total edge weight, ties to the lesser label; deterministic, fixed rounds.
    A node weighs its own label as much as its heaviest edge, which keeps pairs from swapping labels for ever."""
    arcs = cut(both_ways(links), "arcs")
    own = arcs.groupBy("a").agg(F.max("weight").alias("w")).withColumnRenamed("a", "item")
    labels = own.select("item", F.col("item").alias("community"))
    for _ in range(rounds):
        votes = arcs.join(labels.withColumnRenamed("item", "b"), "b").select(F.col("a").alias("item"), "community", "weight").unionByName(labels.join(own, "item").select("item", "community", F.col("w").alias("weight")))
        sums = votes.groupBy("item", "community").agg(F.sum("weight").alias("w"))
        best = sums.groupBy("item").agg(F.min(F.struct((-F.col("w")).alias("v"), F.col("community"))).alias("m"))
        labels = cut(best.select("item", F.col("m.community").alias("community")), "labels")
    return labels


def heavy(nodes: DataFrame, links: DataFrame, frequency: int, weight: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (item, frequency) of at least ``frequency`` and edges of at least ``weight`` between such nodes."""
    kept = nodes.filter(F.col("frequency") >= frequency)
    a, b = kept.select(F.col("item").alias("a")), kept.select(F.col("item").alias("b"))
    return kept, links.filter(F.col("weight") >= weight).join(a, "a", "left_semi").join(b, "b", "left_semi").select("a", "b", "weight")
