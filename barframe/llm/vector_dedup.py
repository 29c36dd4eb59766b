"""Embedding near-dedup by NN-descent.

Equal vectors are one node (a list of them is never compared with itself). A first neighbour graph comes from random hyperplane buckets; then
neighbours of neighbours are joined again and again, and every node keeps its nearest
``neighbours``. Recall is audited against brute force over all rows for a bounded set of nodes and
rounds go on until it is reached. A node whose list is full of links (saturated) gets a larger
list: it is compared with every node of its component, in blocks, so all its links are counted.
Links between saturated nodes of different components are searched with lists that leave out the
own component, and components so linked become one, until nothing is found; the audit of saturated
nodes asks whether all their links lie within their component.
Links are pairs with a cosine of at least ``min_cosine``, in double precision.

A bucket is cut into parts of at most ``PART`` nodes for the first graph only; what such a cut
separates is found again by the descent, which the audit measures. The audit's bound is a parameter; every round covers all nodes.

Edge cases: vectors that are NULL, empty, zero or hold a NULL or non-finite component link with
nothing; vectors of different lengths never link; repeated ids are separate vectors that link by
their values and share the id; ties among neighbours go to the smaller id; an empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barframe.llm.components import connected_components
from barframe.plans.workspace import scratch_path

MIN_COSINE = 0.95
NEIGHBOURS = 12
TABLES = 6
PART = 400
MAX_ROUNDS = 8
AUDIT_NODES = 200
MIN_RECALL = 0.99
BLOCK = 256


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in values]) if len(values) else np.zeros((0, 0))


def _scaled(values) -> np.ndarray:
    """Each vector divided by its largest component, so that no square over- or underflows."""
    rows = _matrix(values)
    return rows / np.abs(rows).max(axis=1, keepdims=True) if rows.size else rows


def _unit(values) -> np.ndarray:
    rows = _scaled(values)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _nearest(sims: np.ndarray, ids: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest of each row, without those of the same ``own``; ties to the smaller id."""
    sims = sims.copy()
    sims[own[:, None] == own[None, :]] = -2
    k = min(k, len(ids) - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    best = np.lexsort((np.broadcast_to(ids, sims.shape), -sims), axis=1)[:, :k] if len(ids) <= 64 else np.argpartition(-sims, k - 1, axis=1)[:, :k]
    a, b = np.repeat(np.arange(len(ids)), k), best.ravel()
    others = sims[a, b] > -2
    return a[others], b[others]


def bucket_graph(nodes: DataFrame, count: int, dim: int, k: int, tables: int = TABLES, part: int = PART, seed: int = 11) -> DataFrame:
    """``src, dst, sim``: each node's nearest within its hyperplane buckets, of other values of ``own`` only."""
    bits = max(int(np.ceil(np.log2(max(count, 1) / (part / 4)))), 0)
    planes = np.random.default_rng(seed).standard_normal((tables, min(bits, 48), dim))

    def signs(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in found:
            unit = _scaled(rows["vec"])
            for t in range(tables):
                key = ((unit @ planes[t].T > 0) @ (1 << np.arange(planes.shape[1], dtype=np.int64))).astype(np.int64)
                yield pd.DataFrame({"node": rows["node"], "own": rows["own"], "table": t, "key": key, "vec": rows["vec"]})

    kind = nodes.schema["vec"].dataType.simpleString()
    keyed = nodes.mapInPandas(signs, f"node bigint, own bigint, table int, key bigint, vec {kind}")
    # Large buckets are cut by a hash, a new one in each table.
    sizes = keyed.groupBy("table", "key").count().where(F.col("count") > part)
    parted = keyed.join(sizes, ["table", "key"], "left").withColumn(
        "part", F.pmod(F.xxhash64("node", "table"), F.ceil(F.coalesce("count", F.lit(1)) / F.lit(part)).cast("long"))
    )

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        ids, unit = rows["node"].to_numpy(), _unit(rows["vec"])
        sims = unit @ unit.T
        a, b = _nearest(sims, ids, k, rows["own"].to_numpy())
        return pd.DataFrame({"src": ids[a], "dst": ids[b], "sim": sims[a, b]})

    return parted.groupBy("table", "key", "part").applyInPandas(compared, "src bigint, dst bigint, sim double")


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """Each node's ``k`` nearest of the pairs."""
    best = pairs.groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def descend(graph: DataFrame, nodes: DataFrame, k: int, turn: int = 0) -> DataFrame:
    """One round, the ``turn``-th: every node's neighbours (of either direction) are compared with each other."""
    reverse_rank = F.row_number().over(Window.partitionBy("dst").orderBy(F.xxhash64("src", "dst", F.lit(turn))))
    forward = graph.select(F.col("src").alias("hub"), F.col("dst").alias("node"))
    # A hub's nearest k see all; of the nodes that name it, k by a hash are compared in this round.
    backward = graph.withColumn("r", reverse_rank).where(F.col("r") <= k).select(F.col("dst").alias("hub"), F.col("src").alias("node"))
    own = graph.select(F.col("src").alias("hub"), F.col("src").alias("node"))
    members = forward.union(backward).union(own).distinct()
    worst = graph.groupBy(F.col("src").alias("node")).agg(F.min("sim").alias("worst"))
    carried = members.join(nodes.join(worst, "node", "left"), "node")

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        ids, unit = rows["node"].to_numpy(), _unit(rows["vec"])
        sims = unit @ unit.T
        a, b = _nearest(sims, ids, k, rows["own"].to_numpy())
        better = sims[a, b] > rows["worst"].fillna(-2).to_numpy()[a]
        return pd.DataFrame({"src": ids[a[better]], "dst": ids[b[better]], "sim": sims[a[better], b[better]]})

    found = carried.groupBy("hub").applyInPandas(compared, "src bigint, dst bigint, sim double")
    return _top(graph.select("src", "dst", "sim").union(found), k)


def recall(
    links: DataFrame, asked: DataFrame, nodes: DataFrame, min_cosine: float, sample: int = AUDIT_NODES, reach: DataFrame | None = None,
) -> float:
    """Share of the true links of asked nodes that ``links`` holds, or a component of ``reach``, by brute force over all nodes.

    Asked are ``sample`` nodes by a hash, and ``sample`` of those with links, which tell more.
    """
    linked = asked.join(links.select(F.col("src").alias("node")).distinct(), "node", "left_semi")
    rows = [r for df in (asked, linked) for r in df.orderBy(F.xxhash64("node"), "node").limit(sample).collect()]
    if not rows:
        return 1.0
    kept = {r["node"]: r["vec"] for r in rows}
    ids, unit = np.array(list(kept)), _unit(list(kept.values()))

    def compared(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in found:
            if len(block):
                a, b = np.nonzero(unit @ _unit(block["vec"]).T >= min_cosine)
                other = block["node"].to_numpy()
                keep = ids[a] != other[b]
                yield pd.DataFrame({"src": ids[a[keep]], "dst": other[b[keep]]})

    truth = nodes.mapInPandas(compared, "src bigint, dst bigint")
    met = truth.join(links.withColumn("hit", F.lit(1)), ["src", "dst"], "left")
    if reach is not None:
        for end in ("src", "dst"):
            met = met.join(reach.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
        met = met.withColumn("hit", F.when(F.col("of_src") == F.col("of_dst"), 1).otherwise(F.col("hit")))
    total, hits = met.agg(F.count("*"), F.count("hit")).first()
    return hits / total if total else 1.0


def neighbour_graph(nodes: DataFrame, count: int, dim: int, min_cosine: float, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The neighbour graph, the links in it (``src, dst``, both ways), and the saturated nodes.

    Rounds go on until the audited recall is reached; after one that does not raise it, the nearest of new
    hyperplane buckets join the lists. ``MAX_ROUNDS`` rounds in a row without any gain are an error.
    """
    graph = _written(_top(bucket_graph(nodes, count, dim, k), k), "nn-graph")
    best, idle, turn = 0.0, 0, 0
    while True:
        graph = _written(descend(graph, nodes, k, turn), "nn-graph")
        near = graph.where(F.col("sim") >= min_cosine)
        links = _written(near.select("src", "dst").union(near.select("dst", "src")).distinct(), "nn-links")
        full = _written(near.groupBy(F.col("src").alias("node")).count().where(F.col("count") >= k).select("node"), "nn-full")
        share = recall(links, nodes.join(full, "node", "left_anti"), nodes, min_cosine)
        if share >= MIN_RECALL:
            return graph, links, full
        idle = 0 if share > best else idle + 1
        if idle == MAX_ROUNDS:
            raise RuntimeError(f"{max(best, share):.4f} of the audited links found, {MIN_RECALL} wanted")
        best, turn = max(best, share), turn + 1
        if idle:
            fresh = bucket_graph(nodes, count, dim, k, seed=1000 + turn)
            graph = _written(_top(graph.select("src", "dst", "sim").union(fresh), k), "nn-graph")


def reached(
    graph: DataFrame, links: DataFrame, full: DataFrame, nodes: DataFrame, dim: int, min_cosine: float, k: int,
) -> DataFrame:
    """``node, component``: parts of the graph that hold all links of the saturated nodes.

    At first a component has the nodes that neighbours at up to twice the angle of a link connect. A
    saturated node's list may end within its own dense group, so these nodes are searched again, in new
    buckets, for the nearest of other components; linked components become one. Links with a node that is
    not saturated are in that node's list.
    """
    reach = _written(connected_components(graph.where(F.col("sim") >= 2 * min_cosine**2 - 1).select("src", "dst")), "nn-reach")
    dense = full.join(nodes, "node")
    seed, idle = 11, 0
    while True:
        apart = _written(dense.join(reach, "node").withColumnRenamed("component", "own").select("node", "own", "vec"), "nn-dense")
        count, parts = apart.agg(F.count("*"), F.count_distinct("own")).first()
        if parts < 2:
            break
        seed += 1
        across = _written(_top(bucket_graph(apart, count, dim, k, seed=seed), k), "nn-across")
        across = _written(descend(across, apart, k, seed).where(F.col("sim") >= min_cosine), "nn-across")
        label = lambda end: reach.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = _written(
            across.join(label("src"), "src").join(label("dst"), "dst").select(F.col("of_src").alias("src"), F.col("of_dst").alias("dst")).distinct(),
            "nn-merged",
        )
        if not pairs.isEmpty():
            roots = connected_components(pairs).select(F.col("node").alias("component"), F.col("component").alias("root"))
            reach = _written(reach.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "nn-reach")
            idle = 0
            continue
        share = recall(links, dense, nodes, min_cosine, reach=reach)
        if share >= MIN_RECALL:
            break
        idle += 1
        if idle == MAX_ROUNDS:
            raise RuntimeError(f"saturated nodes: {share:.4f} of the audited links found, {MIN_RECALL} wanted")
    return reach


def _block_roots(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows ``a`` and columns ``b`` the smallest node that links within the block connect them with."""
    top = np.iinfo(np.int64).max
    while True:
        to_b = np.minimum(b, np.where(near, a[:, None], top).min(axis=0))
        to_a = np.minimum(a, np.where(near, to_b[None, :], top).min(axis=1))
        if (to_a == a).all() and (to_b == b).all():
            return a, b
        a, b = to_a, to_b


def enlarged(reach: DataFrame, full: DataFrame, nodes: DataFrame, min_cosine: float) -> tuple[DataFrame, DataFrame]:
    """``node, links`` (vectors linked, by copies) of the saturated nodes, and enough of their links to connect them.

    A saturated node is compared with all nodes of its component in ``reach``, block by block; a block
    pair returns sums, not pairs.
    """
    asked = reach.join(full.withColumn("asked", F.lit(True)), "node", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    sizes = asked.groupBy("component").agg(F.count("*").alias("n"), F.max("asked").alias("any")).where("any").select(
        "component", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    )
    members = asked.join(sizes, "component").join(nodes, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = members.where("asked").select("component", F.col("own").alias("a"), others.alias("b"), F.lit(True).alias("left"), "node", "vec", "copies")
    right = members.select("component", others.alias("a"), F.col("own").alias("b"), F.lit(False).alias("left"), "node", "vec", "copies")

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows["left"]], rows[~rows["left"]]
        if a.empty or b.empty:
            return pd.DataFrame({"node": [], "links": [], "other": []})
        ids, other = a["node"].to_numpy(), b["node"].to_numpy()
        near = (_unit(a["vec"]) @ _unit(b["vec"]).T >= min_cosine) & (ids[:, None] != other[None, :])
        sums = near @ b["copies"].to_numpy()
        first, back = _block_roots(near, ids, other)
        hit, struck = near.any(axis=1), near.any(axis=0)
        return pd.DataFrame({
            "node": np.concatenate([ids[hit], other[struck]]), "links": np.concatenate([sums[hit], np.zeros(struck.sum(), sums.dtype)]),
            "other": np.concatenate([first[hit], back[struck]]),
        })

    made = left.unionByName(right).groupBy("component", "a", "b").applyInPandas(compared, "node bigint, links bigint, other bigint")
    made = _written(made, "nn-enlarged")
    counted = full.join(made.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").select("node", F.coalesce("links", F.lit(0)).alias("links"))
    return counted, made.select(F.col("node").alias("src"), F.col("other").alias("dst")).distinct()


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", min_cosine: float = MIN_COSINE, k: int = NEIGHBOURS,
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every vector."""
    infinite = F.lit(float("inf"))
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < infinite))
    usable = F.coalesce(F.col(vec_col).isNotNull() & finite & F.exists(F.col(vec_col), lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(id_col).alias("id"), F.when(usable, F.col(vec_col)).alias("vec"))
    groups = rows.where("vec is not null").groupBy("vec").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    groups = _written(groups.select(F.monotonically_increasing_id().alias("node"), "vec", "first_id", "copies", F.size("vec").alias("dim")), "nn-nodes")
    counts, edges = [], []
    for dim, count in sorted(tuple(r) for r in groups.groupBy("dim").count().collect()):
        nodes = groups.where(F.col("dim") == dim).select("node", "vec", "copies")
        single = nodes.select("node", F.col("node").alias("own"), "vec")
        graph, links, full = neighbour_graph(single, count, dim, min_cosine, k)
        few = links.join(full, links["src"] == full["node"], "left_anti").join(
            nodes.select(F.col("node").alias("dst"), "copies"), "dst"
        ).groupBy(F.col("src").alias("node")).agg(F.sum("copies").alias("links"))
        reach = reached(graph, links, full, single.select("node", "vec"), dim, min_cosine, k)
        many, more = enlarged(reach, full, nodes, min_cosine)
        counts.append(few.unionByName(many))
        edges.append(links.unionByName(more))
    if not counts:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
        )
    linked, joined = counts[0], edges[0]
    for more_counts, more_edges in zip(counts[1:], edges[1:]):
        linked, joined = linked.unionByName(more_counts), joined.unionByName(more_edges)
    roots = connected_components(joined)
    classes = groups.join(linked, "node", "left").join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(first, "component").select(
        F.col("vec").alias("own"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("component_id").alias("found")
    )
    out = rows.join(classes, rows["vec"] == classes["own"], "left")
    component = F.coalesce("found", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
