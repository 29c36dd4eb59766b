"""A trie of conversations' prefixes, summed up by an Euler tour.

A turn is known by the digest of its role and text, and a prefix by a 127-bit fingerprint of its
turns' digests, so texts are read once and never shuffled. Each distinct prefix is a node. Nodes are sorted
with their children behind them; from a row and the next follow every node's parent, first child
and next sibling, and with them the tour: an arc that enters each node and one that leaves it, each
with its successor.

The tour is ranked by contraction: in each round every arc draws a coin, an arc that draws 0 takes
over its successor if that drew 1, and the shorter list is written; when at most ``TAIL`` arcs are
left they are ranked in one go, and the arcs taken over get their ranks back round by round. Prefix
sums over the ranked arcs give a node's subtree as the difference between its two arcs.

Nothing is grouped into one row: turns, siblings and arcs are scanned over range partitions, so a
conversation, a first turn or a parent may hold any share of all rows. The digest of a node's
members is made from chunks of ``CHUNK_IDS`` sorted ids, streamed through one hash.

Edge cases: turns go by number, a NULL number first, equal numbers by the turn's digest, so that
repeated rows are turns each; NULL roles and texts are empty; rows with a NULL conversation belong
to none and are left out; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.llm.scan import segmented_scan
from barframe.plans.workspace import scratch_path

#: The tour is contracted until so few arcs are left.
TAIL = 2048
CHUNK_IDS = 65_536
_WORD = r"[^\x20\x09-\x0D]+"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def turn_digests(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, place, digest, words``: every turn's place in its conversation, from 0, its digest and its text's words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    )
    placed = segmented_scan(turns, ["conv_id"], ["turn", "digest"])
    return _written(placed.select("conv_id", F.col("index").alias("place"), "digest", "words"), "turns")


def splice_heads(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """``turns`` with each conversation's first ``heads`` turns replaced by those of conversation ``base``.

    ``base`` and ``heads`` are expressions on ``conv_id``; ``heads`` is at most ``most``. A conversation
    whose turns all go, and whose base is absent, is left without rows: see ``prefix_trie``'s ``ids``.
    """
    ids = turns.select("conv_id").distinct()
    donors = turns.where(F.col("place") < most).select(F.col("conv_id").alias("__base"), "place", "digest", "words")
    wanted = ids.select("conv_id", base.alias("__base"), heads.alias("__heads")).where("__heads > 0")
    taken = wanted.join(donors, "__base").where("place < __heads").select("conv_id", "place", "digest", "words")
    return taken.unionByName(turns.where(F.col("place") >= heads))


def list_rank(arcs: DataFrame, tail: int = TAIL) -> DataFrame:
    """``a, b, rank`` for a list of arcs ``(a, b)`` with successors ``(na, nb)``: the arcs that follow each."""
    spark = arcs.sparkSession
    alive = _written(arcs.select("a", "b", "na", "nb", F.when(F.col("na").isNull(), 0).otherwise(1).cast("long").alias("w")), "arcs")
    taken: list[DataFrame] = []
    while alive.count() > tail:
        coin = F.xxhash64("a", "b", F.lit(len(taken))).bitwiseAND(1) == 0
        keeps = alive.where(coin).select(*[F.col(c).alias(f"u{c}") for c in alive.columns])
        goes = alive.where(~coin)
        met = (F.col("una") == F.col("a")) & (F.col("unb") == F.col("b"))
        pairs = _written(keeps.join(goes, met, "full_outer"), "arc-pairs")
        both = F.col("ua").isNotNull() & F.col("a").isNotNull()
        own = lambda c: F.when(F.col("ua").isNull(), F.col(c)).otherwise(F.when(both, F.col(c)).otherwise(F.col(f"u{c}")))
        first = lambda c: F.coalesce(f"u{c}", c)
        alive = pairs.select(
            F.when(F.col("ua").isNull(), F.col("a")).otherwise(F.col("ua")).alias("a"),
            first("b").alias("b"), own("na").alias("na"), own("nb").alias("nb"),
            (F.coalesce("uw", F.lit(0)) + F.coalesce("w", F.lit(0))).alias("w"),
        )
        taken.append(pairs.where(both).select("a", "b", "na", "nb", "w"))
    # The rest, at most `tail` arcs, is walked from its end.
    rest = alive.toArrow().to_pylist()
    before = {(r["na"], r["nb"]): r for r in rest}
    ranked, at, rank = [], before.get((None, None)), 0
    while at is not None:
        rank += at["w"]
        ranked.append((at["a"], at["b"], rank))
        at = before.get((at["a"], at["b"]))
    known = spark.createDataFrame(ranked, "a long, b long, rank long")
    for gone in reversed(taken):
        after = known.select(F.col("a").alias("na"), F.col("b").alias("nb"), "rank")
        found = gone.join(after, ["na", "nb"], "left").select("a", "b", (F.col("w") + F.coalesce("rank", F.lit(0))).alias("rank"))
        known = _written(known.unionByName(found), "ranks")
    return known


def member_digests(ends: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """``key_hi, key_lo, ends_sha256``: SHA-256 of each key's ``conv_id`` in ascending order, decimal, joined by commas."""

    def chunks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        key = None
        for batch in found:
            high, low, ids = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(high) != 0) | (np.diff(low) != 0)) + 1
            out = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if key != (high[a], low[a]) or len(held) >= chunk_ids:
                    if held:
                        out.append((*key, held[0], ",".join(map(str, held))))
                    key, held = (high[a], low[a]), []
                held += ids[a:b].tolist()
            yield as_batch(out)
        if held:
            yield as_batch([(*key, held[0], ",".join(map(str, held)))])

    def as_batch(rows: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["key_hi", "key_lo", "first", "ids"]
        )

    def digests(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in found:
            out = []
            for high, low, ids in zip(*(batch.column(c).to_pylist() for c in ("key_hi", "key_lo", "ids"))):
                if key == (high, low):
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (high, low), hashlib.sha256(ids.encode())
            yield named(out)
        if key is not None:
            yield named([(*key, state.hexdigest())])

    def named(rows: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["key_hi", "key_lo", "ends_sha256"]
        )

    order = ["key_hi", "key_lo", "conv_id"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = dealt.mapInArrow(chunks, "key_hi bigint, key_lo bigint, first bigint, ids string")
    dealt = parts.repartition("key_hi", "key_lo").sortWithinPartitions("key_hi", "key_lo", "first")
    return dealt.mapInArrow(digests, "key_hi bigint, key_lo bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None, tail: int = TAIL) -> DataFrame:
    """One row for each node of the trie of ``turns`` (``conv_id, place, digest, words``).

    ``conv_id`` is the smallest of a node's members, and identifies it together with ``depth``.
    ``parent_conv_id``: the parent's; ``n_convs``: members; ``n_children``; ``n_leaves``: nodes without
    children in the subtree; ``saved_tokens``: words that a shared prefix saves, over the subtree;
    ``ends_sha256``: the digest of the members that end at the node. ``ids`` names the conversations
    (default: those of ``turns``); one without turns is a member of the root.
    """
    ids = turns.select("conv_id").distinct() if ids is None else ids
    roots = ids.select("conv_id", F.lit(-1).cast("long").alias("place"), F.unhex(F.lit("")).alias("digest"), F.lit(0).cast("long").alias("words"))
    rows = _written(
        segmented_scan(roots.unionByName(turns.select(roots.columns)), ["conv_id"], ["place"], chain="digest").drop("digest", "place"),
        "prefixes",
    )
    nodes = _written(
        rows.groupBy("key_hi", "key_lo").agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("index").alias("depth"), F.min("words").alias("words"),
            F.min("before_hi").alias("before_hi"), F.min("before_lo").alias("before_lo"),
        ),
        "nodes",
    )
    # Every node, then its children: the first row of a family is the node itself.
    zero = F.lit(0).cast("long")
    heads = nodes.select(
        F.col("key_hi").alias("g_hi"), F.col("key_lo").alias("g_lo"), F.lit(0).alias("kind"), "conv_id", "depth", "n_convs", "words",
        F.col("conv_id").alias("parent_conv_id"),
    )
    children = nodes.where("depth > 0").select(
        F.col("before_hi").alias("g_hi"), F.col("before_lo").alias("g_lo"), F.lit(1).alias("kind"), "conv_id", "depth", "n_convs", "words",
        zero.alias("parent_conv_id"),
    )
    family = _written(
        segmented_scan(heads.unionByName(children), ["g_hi", "g_lo"], ["kind", "conv_id"], sums=["parent_conv_id"], lead=["conv_id"]), "families"
    )
    head, step = family.where("kind = 0"), F.col("depth") * 2
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    enter = head.select(
        F.col("conv_id").alias("a"), step.alias("b"), F.coalesce("conv_id_next", "conv_id").alias("na"),
        F.when(F.col("last"), step + 1).otherwise(step + 2).alias("nb"), F.col("last").cast("long").alias("leaf"), saved,
    )
    leave = family.where("kind = 1").select(
        F.col("conv_id").alias("a"), (step + 1).alias("b"), F.when(F.col("last"), F.col("parent_conv_id_upto")).otherwise(F.col("conv_id_next")).alias("na"),
        F.when(F.col("last"), step - 1).otherwise(step).alias("nb"), zero.alias("leaf"), zero.alias("saved"),
    )
    end = head.where("depth = 0").select(
        F.col("conv_id").alias("a"), (step + 1).alias("b"), F.lit(None).cast("long").alias("na"), F.lit(None).cast("long").alias("nb"),
        zero.alias("leaf"), zero.alias("saved"),
    )
    arcs = _written(enter.unionByName(leave).unionByName(end), "tour")
    ranked = arcs.join(list_rank(arcs, tail), ["a", "b"]).select(F.lit(0).alias("tour"), (-F.col("rank")).alias("position"), "a", "b", "leaf", "saved")
    sums = segmented_scan(ranked, ["tour"], ["position"], sums=["leaf", "saved"])
    leaves = F.col("b").bitwiseAND(1) == 1
    subtree = lambda c: F.sum(F.when(leaves, F.col(f"{c}_upto")).otherwise(F.col(c) - F.col(f"{c}_upto")))
    below = sums.groupBy("a", F.shiftright("b", 1).alias("d")).agg(subtree("leaf").alias("n_leaves"), subtree("saved").alias("saved_tokens"))
    n_children = family.where("kind = 1").groupBy(F.col("parent_conv_id_upto").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    parents = family.where("kind = 1").select("conv_id", "depth", F.col("parent_conv_id_upto").alias("parent_conv_id"))
    return (
        nodes.select("key_hi", "key_lo", "conv_id", "depth", "n_convs")
        .join(below.select(F.col("a").alias("conv_id"), F.col("d").alias("depth"), "n_leaves", "saved_tokens"), ["conv_id", "depth"])
        .join(parents, ["conv_id", "depth"], "left")
        .join(n_children, ["conv_id", "depth"], "left")
        .join(member_digests(rows.where("last")), ["key_hi", "key_lo"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
