"""Graph features of the topology. Edges are rows (src, dst); iterations are joins whose results are written to
the checkpoint folder each round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .betweenness import betweenness
from .components import components
from .shared import cut


def undirected_edges(links: DataFrame) -> DataFrame:
    """a < b: each linked pair once, without loops."""
    return (
        links.where("src is not null and dst is not null and src != dst")
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .distinct()
    )


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )


def degrees(edges: DataFrame) -> DataFrame:
    return _both(edges).groupBy("node").agg(F.count("*").alias("degree"))


def clustering(edges: DataFrame) -> DataFrame:
    """node, clustering. Each edge points to its end of higher degree, so a hub has few edges out and the wedges
    stay few; a triangle is a wedge whose ends are linked."""
    deg = degrees(edges)
    d = edges.join(deg.select(F.col("node").alias("a"), F.col("degree").alias("da")), "a").join(
        deg.select(F.col("node").alias("b"), F.col("degree").alias("db")), "b"
    )
    up = F.struct("da", "a") < F.struct("db", "b")
    out = d.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("y"))
    wedges = out.alias("p").join(out.select("x", F.col("y").alias("z")).alias("q"), "x").where("y < z").select("x", F.col("y").alias("a"), F.col("z").alias("b"))
    triangles = wedges.join(edges, ["a", "b"])
    corners = triangles.select(F.explode(F.array("x", "a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("t"))
    pairs = F.col("degree") * (F.col("degree") - 1)
    value = F.when(pairs > 0, 2.0 * F.coalesce("t", F.lit(0)) / pairs).otherwise(0.0)
    return deg.join(corners, "node", "left").select("node", value.alias("clustering"))


def component_sizes(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node), component_size for nodes with an edge."""
    found = components(edges.select("a", "b"))
    size = found.groupBy("root").agg(F.count("*").alias("component_size"))
    return found.join(size, "root").select("node", F.col("root").alias("component"), "component_size")


def topo_layer(degree: Column) -> Column:
    """Degree bins (-1, 1], (1, 5], (5, 15] and above."""
    return F.when(degree <= 1, 0).when(degree <= 5, 1).when(degree <= 15, 2).otherwise(3)


def graph_features(elements: DataFrame, links: DataFrame, pivots: int = 0, seed: int = 0) -> DataFrame:
    """ID with GRAPH_DEGREE, CLUSTERING_COEF, COMPONENT_SIZE, IS_LEAF, IS_ISOLATED, TOPO_LAYER, and BETWEENNESS if
    pivots are asked for. Ends that are no element count in the graph and then vanish."""
    edges = cut(undirected_edges(links))
    found = degrees(edges).join(clustering(edges), "node").join(component_sizes(edges).drop("component"), "node")
    if pivots:
        found = found.join(betweenness(edges, pivots, seed), "node")
    df = elements.select("ID").join(found, F.col("ID") == F.col("node"), "left").drop("node")
    degree = F.coalesce("degree", F.lit(0))
    extra = [F.coalesce("betweenness", F.lit(0.0)).alias("BETWEENNESS")] if pivots else []
    return df.select(
        "ID",
        degree.alias("GRAPH_DEGREE"),
        F.coalesce("clustering", F.lit(0.0)).alias("CLUSTERING_COEF"),
        F.coalesce("component_size", F.lit(1)).alias("COMPONENT_SIZE"),
        (degree == 1).cast("int").alias("IS_LEAF"),
        (degree == 0).cast("int").alias("IS_ISOLATED"),
        topo_layer(degree).alias("TOPO_LAYER"),
        *extra,
    )


def hierarchy_depths(elements: DataFrame, most: int = 20) -> DataFrame:
    """ID, HIERARCHY_DEPTH: steps to an element without a known parent; a walk ends at the first repeated element
    and after ``most`` + 1 steps."""
    ids = elements.select(F.col("ID").alias("parent")).distinct()
    parents = cut(elements.select("ID", F.col("PARENT_NE_ID_FK").alias("parent")).where("parent is not null").join(ids, "parent").select("ID", "parent"))
    step = parents.select(F.col("ID").alias("at"), F.col("parent").alias("next"))
    walks = elements.select("ID", F.col("ID").alias("at"), F.lit(0).alias("depth"), F.array("ID").alias("seen"))
    done = None
    for _ in range(most + 1):
        moved = cut(walks.join(step, "at", "left"))
        ended = moved.where("next is null").select("ID", "depth")
        moved = moved.where("next is not null").withColumn("depth", F.col("depth") + 1)
        repeated = F.array_contains("seen", F.col("next"))
        ended = ended.union(moved.where(repeated).select("ID", "depth"))
        done = ended if done is None else done.union(ended)
        walks = moved.where(~repeated).select("ID", F.col("next").alias("at"), "depth", F.array_append("seen", F.col("next")).alias("seen"))
        if walks.isEmpty():
            break
    return done.union(walks.select("ID", "depth")).withColumnRenamed("depth", "HIERARCHY_DEPTH")


def hierarchy_features(elements: DataFrame) -> DataFrame:
    geo = [f"GEOGRAPHY_L{i}_ID_FK" for i in range(1, 5)]
    filled = sum((F.col(c).isNotNull().cast("int") for c in geo), F.lit(0))
    return elements.select(
        "ID", F.col("PARENT_NE_ID_FK").isNull().cast("int").alias("IS_ROOT_NODE"), filled.alias("GEO_COMPLETENESS"), *geo
    ).join(hierarchy_depths(elements), "ID")


def entity_neighbours(elements: DataFrame, links: DataFrame) -> DataFrame:
    """entity, neighbour: closed one-hop neighbourhood by external id; links of unknown elements are left out."""
    ids = elements.select("ID", "NE_ID").where("NE_ID is not null")
    pairs = (
        _both(undirected_edges(links))
        .join(ids.select(F.col("ID").alias("node"), F.col("NE_ID").alias("entity")), "node")
        .join(ids.select(F.col("ID").alias("other"), F.col("NE_ID").alias("neighbour")), "other")
        .select("entity", "neighbour")
    )
    return pairs.union(ids.select(F.col("NE_ID"), F.col("NE_ID"))).distinct()


def k_hop(starts: DataFrame, edges: DataFrame, hops: int = 2) -> DataFrame:
    """group, node, hop: the nodes within some hops of each group's start nodes (starts: group, node)."""
    both = _both(edges)
    frontier = seen = cut(starts.select("group", "node", F.lit(0).alias("hop")).distinct())
    for hop in range(1, hops + 1):
        found = frontier.join(both, "node").select("group", F.col("other").alias("node")).distinct()
        frontier = cut(found.join(seen, ["group", "node"], "left_anti").withColumn("hop", F.lit(hop)))
        seen = seen.unionByName(frontier)
    return seen


def normalized_adjacency(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """i, j, weight: the non-zero entries of D^-1/2 (A + I) D^-1/2, with 1e-6 added to the degrees."""
    loops = nodes.select(F.col("ID").alias("node"), F.col("ID").alias("other"))
    known = nodes.select(F.col("ID").alias("node"))
    a = _both(edges).join(known, "node", "left_semi").join(known.withColumnRenamed("node", "other"), "other", "left_semi").select("node", "other").union(loops)
    scale = a.groupBy("node").agg(F.pow(F.count("*") + 1e-6, -0.5).alias("s"))
    return (
        a.join(scale, "node")
        .join(scale.select(F.col("node").alias("other"), F.col("s").alias("t")), "other")
        .select(F.col("node").alias("i"), F.col("other").alias("j"), (F.col("s") * F.col("t")).alias("weight"))
    )


def propagate_features(features: DataFrame, adjacency: DataFrame, columns: list[str], hops: int = 2) -> DataFrame:
    """The columns after ``hops`` weighted sums over neighbours (simplified graph convolution)."""
    for _ in range(hops):
        features = cut(
            adjacency.join(features.select(F.col("ID").alias("j"), *columns), "j")
            .groupBy(F.col("i").alias("ID"))
            .agg(*[F.sum(F.col(c) * F.col("weight")).alias(c) for c in columns])
        )
    return features
