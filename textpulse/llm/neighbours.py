"""Near-duplicate vectors by NN-descent.

A graph of neighbour lists is refined by joining neighbours of neighbours, audited against brute force on a
sample, and cut at the threshold. Lists that are full of links, and those of the vectors they hold, are doubled
and refined again, up to WIDEST entries. What is denser is left to an exact count: further lists hold the nearest
vectors of other components until none is a link, and then the links inside the components are counted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.llm.components import connected
from textpulse.llm.shipping import ship

THRESHOLD = 0.95
LIST = 6
# Lists full of links are doubled up to this length; vectors with more links have them counted exactly.
WIDEST = 48
TREES = 4
LEAF = 64
MOST_LEAF = 256
# Backward neighbours a local join looks at; the rest of a hub's are met through their own lists.
BACKWARD = 8
DESCENTS = 3
FEW_UPDATES = 0.002
ROUNDS = 4
# An audit goes on until it has met so many vectors with links whose component is not counted exactly, or has
# compared so many vectors with all others.
AUDIT_LINKED = 300
AUDIT_MOST = 32_768
AUDIT_BLOCK = 256
MOST_BLOCK = 4_096
RECALL = 0.98
TILE = 512
SEED = 11


def _unit(vectors: pd.Series) -> pd.Series:
    """Unit vector as bytes of doubles; null for what links with nothing."""
    out = []
    for v in vectors:
        x = None if v is None else np.asarray(v, np.float64)
        if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
            out.append(None)
            continue
        x = x / np.abs(x).max()
        out.append((x / np.sqrt(x @ x)).tobytes())
    return pd.Series(out, dtype=object)


def _matrix(blobs: pa.ChunkedArray | pa.Array | list, dim: int) -> np.ndarray:
    values = blobs if isinstance(blobs, list) else blobs.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, dim)


def _best(sims: np.ndarray, keep: int, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``keep`` largest of every row, those of its own root aside."""
    sims[root[:, None] == root[None, :]] = -2.0
    keep = min(keep, len(sims) - 1)
    if keep < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    columns = np.argpartition(-sims, keep - 1, axis=1)[:, :keep].ravel()
    rows = np.repeat(np.arange(len(sims)), keep)
    other = sims[rows, columns] > -2.0
    return rows[other], columns[other]


def _leaves(trees: list[int], bits: int) -> Callable:
    """Sends each vector to its leaf of each tree: the signs of its projections on random directions."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in np.unique(batch.column("dim").to_numpy()):
                some = batch.filter(pa.compute.equal(batch.column("dim"), pa.scalar(int(dim), pa.int32())))
                x = _matrix(some.column("vec"), int(dim))
                for tree in trees:
                    if bits:
                        axes = np.random.default_rng([SEED, tree, int(dim)]).standard_normal((int(dim), bits))
                        leaf = ((x @ axes) > 0).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
                    else:
                        leaf = np.zeros(len(x), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), tree, np.int32)), some.column("dim"), pa.array(leaf), some.column("node"), some.column("root"), some.column("vec")],
                        names=["tree", "dim", "leaf", "node", "root", "vec"],
                    )

    return deal


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sim", pa.float64())])
_EDGE_SQL = "a long, b long, sim double"


def _edges(a, b, sim) -> pa.Table:
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())], schema=_EDGE)


def _leaf_lists(keep: int, floor: float) -> Callable:
    def lists(table: pa.Table) -> pa.Table:
        """Best neighbours inside each leaf of a bucket of leaves."""
        frame = table.select(["tree", "dim", "leaf", "sub", "node", "root"]).to_pandas()
        vec = table.column("vec").to_pylist()
        out = [], [], []
        for (_, dim, _, _), at in frame.groupby(["tree", "dim", "leaf", "sub"]).indices.items():
            x = _matrix([vec[i] for i in at], int(dim))
            node = frame["node"].to_numpy()[at]
            sims = x @ x.T
            row, column = _best(sims, keep, frame["root"].to_numpy()[at])
            near = sims[row, column] >= floor
            row, column = row[near], column[near]
            for o, values in zip(out, (node[row], node[column], sims[row, column])):
                o.append(values)
        return _edges(*[np.concatenate(o) if o else [] for o in out])

    return lists


def _local_join(keep: int, floor: float) -> Callable:
    def join(table: pa.Table) -> pa.Table:
        """Neighbours of one centre meet each other; a pair goes on if it betters either side's list, and is among
        the best of its bucket."""
        centre = table.column("centre").to_numpy()
        order = np.argsort(centre, kind="stable")
        node, root, worst, dim = (table.column(c).to_numpy()[order] for c in ("node", "root", "worst", "dim"))
        fresh = table.column("fresh").to_numpy(zero_copy_only=False)[order]
        vec = table.column("vec").to_pylist()
        centre = centre[order]
        starts = np.flatnonzero(np.append(True, centre[1:] != centre[:-1])) if len(centre) else []
        out = [], [], []
        for s, e in zip(starts, np.append(starts[1:], len(centre))):
            if e - s < 2 or not fresh[s:e].any():
                continue
            x = _matrix([vec[i] for i in order[s:e]], int(dim[s]))
            sims = x @ x.T
            better = (sims > worst[s:e][:, None]) & (sims >= floor) & (fresh[s:e][:, None] | fresh[s:e][None, :])
            better &= root[s:e][:, None] != root[s:e][None, :]
            row, column = np.nonzero(better)
            for o, values in zip(out, (node[s:e][row], node[s:e][column], sims[row, column])):
                o.append(values)
        edges = [np.concatenate(o) if o else np.zeros(0) for o in out]
        frame = pd.DataFrame({"a": edges[0].astype(np.int64), "b": edges[1].astype(np.int64), "sim": edges[2]})
        frame = frame[frame["a"] != frame["b"]].drop_duplicates(["a", "b"])
        frame = frame.sort_values(["a", "sim", "b"], ascending=[True, False, True]).groupby("a").head(keep)
        return _edges(frame["a"], frame["b"], frame["sim"])

    return join


def _top(edges: DataFrame, keep: int) -> DataFrame:
    """The best distinct neighbours of every node. An edge met before is not new."""
    once = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("place", place).where(F.col("place") <= keep)


class Graph:
    """Neighbour lists (a, b, sim, new, place) over written ``nodes`` (node, root, dim, vec): only vectors of
    different roots are neighbours. ``paths`` (a, b) are further ways from node to node that a descent goes,
    ``lists`` shorter lists to start from; no entry is less similar than ``floor``."""

    def __init__(
        self, nodes: DataFrame, keep: int = LIST, paths: DataFrame | None = None,
        lists: DataFrame | None = None, floor: float = -2.0,
    ):
        self.nodes, self.keep, self.paths, self.floor, self.spark = nodes, keep, paths, floor, nodes.sparkSession
        self.n = nodes.count()
        # Long lists make small buckets.
        self.buckets = max(8, self.n * keep // (2_000 * LIST))
        self.lists = lists

    def _write(self, df: DataFrame, label: str) -> DataFrame:
        return storage.materialize(df, storage.fresh_dir(self.spark, label))

    def plant(self, trees: list[int]) -> None:
        """Starts, or adds to, the lists from leaves of random trees. A crowded leaf, which may be one group of
        near copies, is dealt out into parts of MOST_LEAF: descent finds what lies across them."""
        bits = max(0, math.ceil(math.log2(max(self.n, 1) / LEAF)))
        dealt = self.nodes.mapInArrow(_leaves(trees, bits), "tree int, dim int, leaf long, node long, root long, vec binary")
        leaf = ["tree", "dim", "leaf"]
        crowded = self._write(
            dealt.drop("vec").groupBy(*leaf).count().where(F.col("count") > MOST_LEAF).select(
                *leaf, F.ceil(F.col("count") / MOST_LEAF).cast("bigint").alias("subs")
            ), "crowded",
        )
        sub = F.coalesce(F.pmod(F.xxhash64("node", "tree"), F.col("subs")), F.lit(0)).cast("bigint")
        split = dealt.join(crowded, leaf, "left").withColumn("sub", sub).drop("subs")
        split = split.withColumn("bucket", F.pmod(F.xxhash64(*leaf, "sub"), F.lit(self.buckets)))
        found = split.groupBy("bucket").applyInArrow(_leaf_lists(self.keep, self.floor), _EDGE_SQL).withColumn("new", F.lit(True))
        if self.lists is not None:
            found = found.unionByName(self.lists.select("a", "b", "sim", "new"))
        self.lists = self._write(_top(found, self.keep), "lists")

    def descend(self) -> int:
        """One refinement; the number of list entries that are new."""
        worst = self.lists.groupBy(F.col("a").alias("node")).agg(
            F.when(F.count(F.lit(1)) >= self.keep, F.min("sim")).otherwise(F.lit(-2.0)).alias("worst")
        )
        sides = self.lists.select(F.col("a").alias("centre"), F.col("b").alias("node"), "new")
        back = self.lists.select(F.col("b").alias("centre"), F.col("a").alias("node"), "new")
        chance = F.row_number().over(
            Window.partitionBy("centre").orderBy(F.desc("new"), F.xxhash64(F.lit(SEED), "centre", "node"))
        )
        back = back.withColumn("place", chance).where(F.col("place") <= BACKWARD).drop("place")
        own = self.nodes.select(F.col("node").alias("centre"), "node", F.lit(True).alias("new"))
        if self.paths is not None:
            sides = sides.unionByName(self.paths.select(F.col("a").alias("centre"), F.col("b").alias("node"), F.lit(False).alias("new")))
        around = sides.unionByName(back).groupBy("centre", "node").agg(F.max("new").alias("fresh"))
        around = around.unionByName(own.select("centre", "node", F.lit(False).alias("fresh")))
        around = around.join(self.nodes, "node").join(worst, "node", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
        around = around.withColumn("bucket", F.pmod(F.xxhash64("centre"), F.lit(self.buckets)))
        found = around.groupBy("bucket").applyInArrow(_local_join(self.keep, self.floor), _EDGE_SQL).withColumn("new", F.lit(True))
        old = self.lists.select("a", "b", "sim", F.lit(False).alias("new"))
        self.lists = self._write(_top(found.unionByName(old), self.keep), "lists")
        return self.lists.where("new").count()

    def refine(self) -> None:
        for _ in range(DESCENTS):
            if self.descend() <= FEW_UPDATES * self.n * self.keep:
                break

    def full(self, threshold: float) -> DataFrame:
        """Nodes whose list is full of links, so that more may be missing."""
        close = self.lists.where(F.col("sim") >= threshold).groupBy(F.col("a").alias("node")).count()
        return self._write(close.where(F.col("count") >= self.keep).select("node"), "full")

    def wider(self, full: DataFrame, threshold: float) -> Graph:
        """Lists twice as long for the ``full`` nodes and those that their lists hold, refined anew.

        A link that no list holds has a full list on both sides, so no other node is needed. The lists hold links
        alone, and start from those there are, all of them new to lists of this length.
        """
        held = self.lists.join(full.withColumnRenamed("node", "a"), "a", "left_semi").select(F.col("b").alias("node"))
        some = self._write(full.unionByName(held).distinct(), "widernodes")
        nodes = self._write(self.nodes.join(some, "node", "left_semi"), "wider")
        inside = [some.withColumnRenamed("node", side) for side in ("a", "b")]
        known = self.lists.where(F.col("sim") >= threshold).join(inside[0], "a", "left_semi").join(inside[1], "b", "left_semi")
        graph = Graph(nodes, 2 * self.keep, lists=known.withColumn("new", F.lit(True)), floor=threshold)
        trees = list(range(trees_for(graph.n, threshold)))
        for i in range(0, len(trees), TREES):
            graph.plant(trees[i : i + TREES])
        graph.refine()
        return graph

    def links(self, threshold: float) -> DataFrame:
        """(a, b) both ways round, once each."""
        close = self.lists.where(F.col("sim") >= threshold).select("a", "b")
        return close.unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _tiles(threshold: float) -> Callable:
    def tile(table: pa.Table) -> pa.Table:
        """One row for a tile: its vectors, their mean direction, and the widest angle from it."""
        dim = int(table.column("dim")[0].as_py())
        x = _matrix(table.column("vec"), dim)
        centre = x.mean(axis=0)
        length = np.sqrt(centre @ centre)
        centre = centre / length if length else x[0]
        wide = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        weight = table.column("weight").to_numpy()
        return pa.table({
            "root": table.column("root")[:1], "tile": table.column("tile")[:1],
            "dim": pa.array([dim], pa.int32()), "nodes": [table.column("node").to_numpy().tobytes()],
            "weights": [weight.astype(np.int64).tobytes()], "vecs": [x.tobytes()], "centre": [centre.tobytes()],
            "wide": [wide], "weight": pa.array([int(weight.sum())], pa.int64()),
        })

    return tile


_TILE_SQL = (
    "root long, tile long, dim int, nodes binary, weights binary, vecs binary, centre binary, wide double, weight long"
)


def _angles(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = zip(a, b)
    return pd.Series(
        [float(np.arccos(np.clip(np.frombuffer(x) @ np.frombuffer(y), -1, 1))) for x, y in pairs], dtype="float64"
    )


def _tile_counts(threshold: float) -> Callable:
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each vector of the first tile with those of the second, itself included where they are one."""
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["vecs"]).reshape(-1, row["dim"])
                y = np.frombuffer(row["vecs2"]).reshape(-1, row["dim"])
                weights = np.frombuffer(row["weights2"], np.int64)
                near = x @ y.T >= threshold
                if row["tile"] == row["tile2"]:
                    np.fill_diagonal(near, True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["nodes"], np.int64)), pa.array(near.astype(np.int64) @ weights)],
                    names=["node", "links"],
                )

    return counts


def component_links(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, links): for ``members`` (root, node, dim, vec, weight), the weight of all vectors of the root's
    component within ``threshold``, the vector itself included. Exact, and no pair is ever a row.

    A component is dealt into tiles of about twice the root of its size, so pairs of tiles are at most as many
    as vectors. Two tiles whose angles show that all or none of their vectors are linked are settled by
    that; the others are multiplied.
    """
    spark = ship(members.sparkSession)
    sizes = members.groupBy("root").count()
    tiles = F.ceil(F.col("count") / F.greatest(F.lit(float(TILE)), 2 * F.sqrt("count"))).cast("bigint")
    dealt = members.join(sizes.select("root", tiles.alias("tiles")), "root").withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles"))
    )
    made = storage.materialize(
        dealt.groupBy("root", "tile").applyInArrow(_tiles(threshold), _TILE_SQL), storage.fresh_dir(spark, "tiles")
    )
    short = made.select("root", "tile", "centre", "wide", "weight")
    pairs = short.join(
        short.select("root", *[F.col(c).alias(f"{c}2") for c in ("tile", "centre", "wide", "weight")]), "root"
    )
    angle = F.pandas_udf(_angles, "double")(F.col("centre"), F.col("centre2"))
    limit, reach = math.acos(threshold), F.col("wide") + F.col("wide2")
    pairs = pairs.withColumn("angle", angle).withColumn(
        "kind", F.when(F.col("angle") + reach <= limit - 1e-9, "all").when(F.col("angle") - reach > limit + 1e-9, "none").otherwise("some")
    ).select("root", "tile", "tile2", "weight2", "kind")
    pairs = storage.materialize(pairs, storage.fresh_dir(spark, "tilepairs"))
    sure = pairs.where("kind = 'all'").groupBy("root", "tile").agg(F.sum("weight2").alias("links"))
    settled = dealt.select("root", "tile", "node").join(sure, ["root", "tile"]).select("node", "links")
    other = made.select("root", *[F.col(c).alias(f"{c}2") for c in ("tile", "vecs", "weights")])
    some = pairs.where("kind = 'some'").join(made.select("root", "tile", "dim", "nodes", "vecs"), ["root", "tile"])
    counted = some.join(other, ["root", "tile2"]).select("tile", "tile2", "dim", "nodes", "vecs", "vecs2", "weights2")
    counted = counted.mapInArrow(_tile_counts(threshold), "node long, links long")
    return settled.unionByName(counted).groupBy("node").agg(F.sum("links").alias("links"))


def _audit_block(nodes: DataFrame, chosen: pd.DataFrame, threshold: float) -> DataFrame:
    """(node, wanted): weight of the true links of the chosen nodes, by comparing them with every vector."""
    shared = nodes.sparkSession.sparkContext.broadcast(chosen)

    def true_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            for dim, part in asked.groupby("dim"):
                some = batch.filter(pa.compute.equal(batch.column("dim"), pa.scalar(int(dim), pa.int32())))
                if not some.num_rows:
                    continue
                node, ask = some.column("node").to_numpy(), part["node"].to_numpy()
                near = _matrix(list(part["vec"]), int(dim)) @ _matrix(some.column("vec"), int(dim)).T >= threshold
                near &= ask[:, None] != node[None, :]
                wanted = near.astype(np.int64) @ some.column("weight").to_numpy()
                met = wanted > 0
                yield pa.RecordBatch.from_arrays([pa.array(ask[met]), pa.array(wanted[met])], names=["node", "wanted"])

    return nodes.mapInArrow(true_links, "node long, wanted long").groupBy("node").agg(F.sum("wanted").alias("wanted"))


def audit(nodes: DataFrame, counts: DataFrame, threshold: float = THRESHOLD, linked: int = AUDIT_LINKED) -> tuple[float, int]:
    """(recall, seen): mean share of its true links that a vector has in ``counts`` (node, links, exact), and how many
    vectors with links were seen. Both count the weights of other nodes; no link is counted that is not one.

    Vectors of ``nodes`` (node, dim, vec, weight) are compared with all others in blocks, in random order, until
    ``linked`` with links were seen outside components counted ``exact``, or every vector was, or AUDIT_MOST were.
    Vectors inside and outside those are averaged apart and the lower counts, so one large group does not hide
    lone pairs.
    """
    # Hash and node order the vectors; a block starts after the last of the block before.
    ordered = nodes.withColumn("place", F.xxhash64(F.lit(SEED), "node"))
    after, size, left = None, AUDIT_BLOCK, AUDIT_MOST
    share, seen = {True: 0.0, False: 0.0}, {True: 0, False: 0}
    while seen[False] < linked and left > 0:
        rest = ordered if after is None else ordered.where(
            (F.col("place") > F.lit(after[0])) | ((F.col("place") == F.lit(after[0])) & (F.col("node") > F.lit(after[1])))
        )
        chosen = rest.orderBy("place", "node").limit(min(size, left)).toPandas()
        if chosen.empty:
            break
        left -= len(chosen)
        after, size = (int(chosen["place"].iloc[-1]), int(chosen["node"].iloc[-1])), min(2 * size, MOST_BLOCK)
        truth = _audit_block(nodes, chosen.drop(columns="place"), threshold)
        part = F.least(F.coalesce("links", F.lit(0)) / F.col("wanted"), F.lit(1.0))
        for row in truth.join(counts, "node").groupBy("exact").agg(F.sum(part).alias("share"), F.count(F.lit(1)).alias("n")).collect():
            share[row["exact"]] += row["share"]
            seen[row["exact"]] += row["n"]
    return min([share[k] / seen[k] for k in seen if seen[k]], default=1.0), sum(seen.values())


def trees_for(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Trees by which a pair at ``threshold`` meets in a leaf with chance ``recall``: trees of ``n`` vectors grow deeper,
    and each level parts such a pair with the same chance."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / LEAF)))
    meets = (1 - math.acos(threshold) / math.pi) ** bits
    return TREES if meets >= 1 else max(TREES, math.ceil(math.log(1 - recall) / math.log(1 - meets)))


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    return storage.materialize(
        classes.select("node", "least").join(connected(links), "node", "left").select(
            "node", F.coalesce("component", "node").alias("root"), "least"
        ),
        storage.fresh_dir(classes.sparkSession, "members"),
    )


def enlarged(graph: Graph, threshold: float) -> tuple[Graph, DataFrame, DataFrame]:
    """(graph, links, full): the graph of the longest lists, the links of all lists, and the nodes whose list is
    full of links even at WIDEST entries."""
    links, full = graph.links(threshold), graph.full(threshold)
    while 2 * graph.keep <= WIDEST and not full.isEmpty():
        graph = graph.wider(full, threshold)
        links, full = links.unionByName(graph.links(threshold)), graph.full(threshold)
    return graph, storage.materialize(links.distinct(), storage.fresh_dir(graph.spark, "veclinks")), full


def joined_components(
    graph: Graph, classes: DataFrame, links: DataFrame, full: DataFrame, threshold: float, trees: list[int]
) -> tuple[DataFrame, DataFrame]:
    """(links, members): ``links`` and those that ``full`` lists of ``graph`` had no room for, and members (node,
    root, least) of the components.

    A link that no list holds has a full list on both sides. Between such nodes lists of the nearest vectors
    of other components are made, along the old lists too; what they link is joined, until no component is.
    """
    spark = graph.spark
    close = graph.lists.where(F.col("sim") >= threshold)
    member = _components(classes, links)
    while True:
        inside = full.join(member, "node").join(classes.select("node", "dim", "vec"), "node")
        inside = storage.materialize(inside.select("node", "root", "dim", "vec"), storage.fresh_dir(spark, "fullnodes"))
        if inside.select("root").distinct().limit(2).count() < 2:
            break
        paths = close.join(full.withColumnRenamed("node", "a"), "a", "left_semi").join(full.withColumnRenamed("node", "b"), "b", "left_semi")
        across = Graph(inside, LIST, paths.select("a", "b"))
        for i in range(0, len(trees), TREES):
            across.plant(trees[i : i + TREES])
        across.refine()
        found = storage.materialize(across.links(threshold), storage.fresh_dir(spark, "crosslinks"))
        if found.isEmpty():
            break
        links = storage.materialize(links.unionByName(found), storage.fresh_dir(spark, "veclinks"))
        member = _components(classes, links)
    return links, member


def node_counts(classes: DataFrame, links: DataFrame, member: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """(node, links, exact): the weight of the other vectors linked with each node. Exact inside components with a full list."""
    spark = classes.sparkSession
    roots = full.join(member, "node").select("root").distinct()
    enlarged = storage.materialize(
        member.join(roots, "root", "left_semi").join(classes.select("node", "dim", "vec", "weight"), "node"),
        storage.fresh_dir(spark, "enlarged"),
    )
    exact = component_links(enlarged.select("root", "node", "dim", "vec", "weight"), threshold)
    listed = links.join(classes.select(F.col("node").alias("b"), "weight"), "b").groupBy(F.col("a").alias("node")).agg(
        F.sum("weight").alias("listed")
    )
    return storage.materialize(
        classes.select("node", "weight").join(listed, "node", "left").join(exact, "node", "left").select(
            "node", F.coalesce(F.col("links") - F.col("weight"), F.col("listed"), F.lit(0)).alias("links"),
            F.col("links").isNotNull().alias("exact"),
        ),
        storage.fresh_dir(spark, "nodecounts"),
    )


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall, recall_seen), a row per vector row.

    Equal vectors are one node with a weight, so a group of copies costs one row. Lists of LIST neighbours
    start from random trees, more of them the deeper they are, and are refined until few entries change; a sample
    is audited, and as long as too few of its links are found more trees are planted, twice as many each time, in
    ROUNDS rounds at most. ``recall`` is what the last audit measured over ``recall_seen`` vectors with links, the
    same in every row. Links are the entries at or above ``threshold``. A list full of links may miss some: such
    lists are doubled (``enlarged``). Components that lists of WIDEST entries keep apart are joined
    (``joined_components``), and the links inside a component with such a list are counted exactly.

    Defined results: a null or zero vector, and one with a null, infinite or undefined component, links with
    nothing; vectors of different length are not compared; repeated rows are vectors of their own; a null
    vec_id links like others, and a component without any id has none; an empty table gives no rows; only
    vec_id and embedding are read.
    """
    spark = ship(rows.sparkSession)
    unit = F.pandas_udf(_unit, "binary")(F.col("embedding").cast("array<double>"))
    given = storage.materialize(
        rows.select(F.col("vec_id"), unit.alias("vec")).withColumn("name", F.sha2("vec", 256)), storage.fresh_dir(spark, "vectors")
    )
    classes = given.where("vec IS NOT NULL").groupBy("name").agg(
        F.first("vec").alias("vec"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")
    )
    classes = storage.materialize(
        classes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", (F.octet_length("vec") / 8).cast("int")),
        storage.fresh_dir(spark, "classes"),
    )
    graph = Graph(classes.select("node", F.col("node").alias("root"), "dim", "vec"))
    planted, recall, seen = 0, 0.0, 0
    for attempt in range(ROUNDS):
        trees = list(range(planted, planted + trees_for(graph.n, threshold) * 2**attempt))
        planted += len(trees)
        for i in range(0, len(trees), TREES):
            graph.plant(trees[i : i + TREES])
        graph.refine()
        wide, links, full = enlarged(graph, threshold)
        links, member = joined_components(wide, classes, links, full, threshold, trees)
        counts = node_counts(classes, links, member, full, threshold)
        recall, seen = audit(classes.select("node", "dim", "vec", "weight"), counts, threshold)
        if recall >= RECALL:
            break
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = (
        classes.select("name", "node", "weight").join(member.select("node", "root"), "node").join(smallest, "root")
        .join(counts, "node")
        .select("name", "component_id", (F.col("links") + F.col("weight") - 1).alias("n_links"))
    )
    return given.select("vec_id", "name").join(per_class, "name", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", F.when(F.col("name").isNull(), F.col("vec_id"))).alias("component_id"),
    ).withColumns({
        "kept": F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)),
        "recall": F.lit(round(recall, 6)), "recall_seen": F.lit(seen).cast("bigint"),
    })
