"""Near-duplicate embeddings by a forest of random-projection trees with spill."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, join_hot, staged

COSINE = 0.95
#: Trees; vectors in the sample that places the cuts (a bound, whatever the table's size); vectors aimed at in a leaf.
TREES, SAMPLE, LEAF_ROWS, SEED = 4, 20_000, 512, 3_301
#: A vector closer to a cut than this, over the root of the dimension, goes to both sides; directions tried for a cut;
#: share of a node's vectors beyond which a side has gained nothing by the cut.
SPILL, TRIES, USELESS = 0.12, 6, 0.9
#: Vectors of one leaf that a task compares with as many others; larger leaves are split further, or compared in such
#: blocks if no cut parts them. What fills up lists of leaves.
BLOCK_ROWS, NO_LEAF = 2048, np.iinfo(np.int64).min


@dataclass
class Node:
    direction: np.ndarray | None = None
    cut: float = 0.0
    sides: list[Node] = field(default_factory=list)
    leaf: int = 0


def grow(sample: np.ndarray, rows_each: float, rng: np.random.Generator, leaves: list[int], depth: int = 0) -> Node:
    """A tree over unit vectors. rows_each: rows of the table that a sampled vector stands for.

    Cuts go through sparse places: of several random directions and of the middle half of each one's positions, the cut
    with the fewest vectors in its margin is taken, so clusters stay whole. A node whose best cut does not part it stays
    a leaf, whatever its size.
    """
    node = Node()
    n, dim = sample.shape
    best = None
    if n * rows_each > LEAF_ROWS and n >= 8 and depth < 40:
        margin = SPILL / dim**0.5
        for _ in range(TRIES):
            direction = rng.standard_normal(dim)
            direction /= np.linalg.norm(direction)
            at = np.sort(sample @ direction)
            cuts = np.quantile(at, np.linspace(0.3, 0.7, 21))
            inside = np.searchsorted(at, cuts + margin, "right") - np.searchsorted(at, cuts - margin, "left")
            k = int(np.argmin(inside))
            if best is None or inside[k] < best[0]:
                best = (inside[k], direction, cuts[k], margin)
    if best:
        _, direction, cut, margin = best
        at = sample @ direction
        low, high = sample[at <= cut + margin], sample[at >= cut - margin]
        if max(len(low), len(high)) < USELESS * n:
            node.direction, node.cut = direction, float(cut)
            node.sides = [grow(low, rows_each, rng, leaves, depth + 1), grow(high, rows_each, rng, leaves, depth + 1)]
            return node
    node.leaf = len(leaves)
    leaves.append(n)
    return node


def leaves_of(node: Node, vectors: np.ndarray, at: np.ndarray, out: list[tuple[np.ndarray, int]]) -> None:
    """(positions, leaf) of all leaves that the vectors at `at` reach, both sides of a cut within its margin."""
    if node.direction is None:
        out.append((at, node.leaf))
        return
    where = vectors[at] @ node.direction
    margin = SPILL / vectors.shape[1] ** 0.5
    for side, inside in zip(node.sides, (where <= node.cut + margin, where >= node.cut - margin), strict=True):
        if inside.any():
            leaves_of(side, vectors, at[inside], out)


def units(lists: list[list[float]]) -> np.ndarray:
    """Rows scaled to length one in double precision; scaling by the largest component first keeps squares finite."""
    x = np.array(lists, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _leaf_names(forests: dict[int, list[Node]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, embedding) -> those and `leaves`: for each tree its leaves, as numbers of dimension, tree and leaf, sorted."""
    for batch in batches:
        lists = batch.column("embedding").to_pylist()
        names: list[list[int]] = [[] for _ in lists]
        for dim in {len(x) for x in lists}:
            at = np.array([k for k, x in enumerate(lists) if len(x) == dim])
            vectors = units([lists[k] for k in at])
            for t, tree in enumerate(forests.get(dim) or [Node()]):
                out: list[tuple[np.ndarray, int]] = []
                leaves_of(tree, vectors, np.arange(len(at)), out)
                for inside, leaf in out:
                    for k in at[inside]:
                        names[k].append((dim << 48) + (t << 32) + leaf)
        names = [sorted(x) for x in names]
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), batch.column("embedding"), pa.array(names, pa.list_(pa.int64()))], ["node", "n", "embedding", "leaves"])


def _by_leaf(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, positions, vectors scaled to length one) of a batch; a leaf's vectors have one dimension."""
    leaves, lists = batch.column("leaf").to_numpy(), batch.column("embedding")
    order = np.argsort(leaves, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(leaves[order])) + 1) if len(order) else []:
        yield int(leaves[at[0]]), at, units(lists.take(pa.array(at)).to_pylist())


def directions(leaf: int, dim: int) -> np.ndarray:
    """(dim, TRIES) directions of length one that belong to a leaf."""
    x = np.random.default_rng((SEED, leaf & (1 << 64) - 1)).standard_normal((dim, TRIES))
    return x / np.linalg.norm(x, axis=0)


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of leaves -> how many lie in each bin, half a margin wide, along each of their leaf's directions."""
    for batch in batches:
        rows = []
        for leaf, at, vectors in _by_leaf(batch):
            dim = vectors.shape[1]
            bins = np.floor(vectors @ directions(leaf, dim) / (SPILL / dim**0.5 / 2)).astype(np.int64)
            for k in range(TRIES):
                found, n = np.unique(bins[:, k], return_counts=True)
                rows += [(leaf, k, b, c) for b, c in zip(found.tolist(), n.tolist(), strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in columns], ["leaf", "way", "bin", "n"])


def _best_cut(pdf: pd.DataFrame) -> pd.DataFrame:
    """One leaf's histograms -> the cut through the sparsest place in the middle of any direction, as an edge of bins, and
    whether it parts the leaf."""
    best = (np.inf, 0, 0, False)
    for way, own in pdf.groupby("way"):
        first = int(own["bin"].min()) - 2
        n = np.zeros(int(own["bin"].max()) - first + 4)
        n[own["bin"] - first] = own["n"]
        below = np.r_[0, np.cumsum(n)]  # below[e]: vectors below edge e
        edges = np.flatnonzero((below >= 0.3 * below[-1]) & (below <= 0.7 * below[-1]))
        edges = edges if len(edges) else np.array([int(np.searchsorted(below, below[-1] / 2))])
        low, high = below[np.minimum(edges + 2, len(n))], below[-1] - below[np.maximum(edges - 2, 0)]
        k = int(np.argmin(low + high))
        best = min(best, (low[k] + high[k], int(way), int(edges[k] + first), bool(max(low[k], high[k]) < USELESS * below[-1])))
    return pd.DataFrame({"leaf": [pdf["leaf"].iloc[0]], "way": [best[1]], "edge": [best[2]], "parts": [best[3]]})


def _to_sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, embedding, leaf, way, edge) -> node, embedding and the new leaf on each side that a vector reaches."""
    for batch in batches:
        positions, names = [], []
        for leaf, at, vectors in _by_leaf(batch):
            dim = vectors.shape[1]
            margin = SPILL / dim**0.5
            way, edge = batch.column("way")[at[0]].as_py(), batch.column("edge")[at[0]].as_py()
            where = (vectors @ directions(leaf, dim))[:, way]
            for side, inside in enumerate((where <= edge * margin / 2 + margin, where >= edge * margin / 2 - margin)):
                name = xxhash.xxh3_64_intdigest(f"{leaf},{side}".encode(), SEED)
                positions.append(at[inside])
                names.append(np.full(int(inside.sum()), name - (1 << 64) if name >> 63 else name, np.int64))
        at = pa.array(np.concatenate(positions) if positions else [], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("node").take(at), batch.column("embedding").take(at), pa.array(np.concatenate(names) if names else [], pa.int64())], ["node", "embedding", "leaf"])


def split_large(named: DataFrame, limit: int = BLOCK_ROWS) -> DataFrame:
    """Stored vectors (node, n, embedding, leaves) -> the same with leaves of more than `limit` vectors split further.

    The sample that placed the first cuts is bounded, so its leaves grow with the table. All large leaves are split level
    by level where their vectors are: one pass counts them along each leaf's random directions, a second sends them to
    the sides of the best cut. Only counts are gathered, a leaf's by one task. A leaf that no cut parts stays.
    """
    members = named.select("node", "embedding", F.explode("leaves").alias("leaf"))
    sizes = staged(members.groupBy("leaf").count(), "leaf-sizes")
    if sizes.filter(F.col("count") > limit).isEmpty():
        return named
    of = lambda rows, large: join_hot(rows, sizes.filter(F.col("count") > limit if large else F.col("count") <= limit), ["leaf"], counted="count").drop("count")
    settled, open_ = of(members, False).select("node", "leaf"), staged(of(members, True), "large-leaves")
    while not open_.isEmpty():
        counts = open_.select("embedding", "leaf").mapInArrow(_histograms, "leaf long, way long, bin long, n long").groupBy("leaf", "way", "bin").agg(F.sum("n").alias("n"))
        cuts = staged(counts.groupBy("leaf").applyInPandas(_best_cut, "leaf long, way long, edge long, parts boolean"), "cuts")
        known = join_hot(open_, cuts, ["leaf"])
        settled = settled.unionByName(staged(known.filter(~F.col("parts")).select("node", "leaf"), "settled"))
        going = known.filter("parts").select("node", "embedding", "leaf", "way", "edge")
        children = staged(going.mapInArrow(_to_sides, "node long, embedding array<double>, leaf long"), "children")
        sizes = staged(children.groupBy("leaf").count(), "leaf-sizes")
        settled = settled.unionByName(staged(of(children, False).select("node", "leaf"), "settled"))
        open_ = staged(of(children, True), "large-leaves")
    leaves = settled.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))  # a list for each vector, of its own leaves
    return staged(named.drop("leaves").join(leaves, "node"), "leaves")


def _padded(lists: list[list[int]]) -> np.ndarray:
    out = np.full((len(lists), max(map(len, lists))), NO_LEAF, np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def _first_meeting(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """Whether `leaf` is the first leaf of the forest that both members of each pair are in."""
    meets = np.zeros(len(a), bool)
    for k in range(a.shape[1]):
        own = a[:, k]
        meets |= (own != NO_LEAF) & (own < leaf) & (b == own[:, None]).any(axis=1)
    return ~meets


def _compare(limit: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One leaf, or one block against another of a large leaf: links of the pairs that meet here first.

    Rows out: (node, links: rows of the table that it links with here, root: the smallest node of its component among
    these vectors).
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        leaf, x = int(pdf["leaf"].iloc[0]), units(pdf["embedding"].tolist())
        names, weight = _padded(pdf["leaves"].tolist()), pdf["n"].to_numpy()
        lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        across = (pdf["block"].to_numpy() == lo) if lo != hi else None
        links, root = np.zeros(len(x), np.int64), np.arange(len(x))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for s in range(0, len(x), 256):
            i, j = np.nonzero(x[s : s + 256] @ x.T >= limit)
            i += s
            keep = i < j if across is None else (i < j) & (across[i] != across[j])
            i, j = i[keep], j[keep]
            keep = _first_meeting(names[i], names[j], leaf)
            i, j = i[keep], j[keep]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            for a, b in zip(i.tolist(), j.tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        ids = pdf["node"].to_numpy()
        linked = links > 0
        return pd.DataFrame({"node": ids[linked], "links": links[linked], "root": ids[[find(k) for k in np.flatnonzero(linked)]] if linked.any() else np.empty(0, np.int64)})

    return run


def usable(embedding: Column) -> Column:
    """Vectors that can link: not null, with a component, all components finite and not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(embedding.isNotNull() & ~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def link_embeddings(table: DataFrame, cosine: float = COSINE, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Embeddings (vec_id, embedding, ...) -> vec_id, n_links, component_id, kept.

    Equal vectors are one node with a count, so copies are never paired. A forest is grown for each dimension from at
    most `sample` vectors drawn by hash; every vector is then put into its leaves of every tree, leaves that are too large
    for their task are split further by all their vectors (split_large), and vectors are compared within leaves in double
    precision. A pair counts in the first leaf where it meets, so no pairs are written: a task returns each vector's number
    of links and its component among the leaf's vectors. A large leaf that no cut parts is compared block by block, each
    pair of blocks a task of its own. Pairs that no leaf joins are missed; pairs below the cosine never link.

    Vectors that can't link (see usable), of other dimensions than any other, or with a null vec_id, have no links and
    are their own component. Repeated rows are vectors of their own that link like copies (one component, counted in
    n_links); different vectors under one vec_id are vectors of their own too, each with its own links. Other columns
    are ignored; no rows give no rows.
    """
    spark = table.sparkSession
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    nodes = good.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    total = nodes.count()
    part = min(1.0, sample / max(total, 1))
    drawn = nodes.filter(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30)) < int(part * (1 << 30))).select("embedding").limit(2 * sample).toArrow().column("embedding").combine_chunks()
    # The sample stays one array of doubles on the driver, never Python numbers.
    flat, sizes = drawn.flatten().to_numpy(), np.diff(drawn.offsets.to_numpy())
    forests = {}
    for dim in np.unique(sizes).tolist():
        own = units(flat[np.repeat(sizes == dim, sizes)].reshape(-1, dim))
        forests[dim] = [grow(own, 1 / part, np.random.default_rng((seed, dim, t)), []) for t in range(trees)]
    shared = spark.sparkContext.broadcast(forests)
    name = lambda batches: _leaf_names(shared.value, batches)
    named = staged(nodes.select("node", "n", "embedding").mapInArrow(name, "node long, n long, embedding array<double>, leaves array<long>"), "leaves")
    named = split_large(named, block_rows)

    placed = named.select("node", "n", "embedding", "leaves", F.explode("leaves").alias("leaf"))
    sizes = staged(placed.groupBy("leaf").agg(F.count("*").alias("rows"), F.ceil(F.count("*") / block_rows).alias("blocks")), "leaf-sizes")
    placed = join_hot(placed, sizes, ["leaf"], counted="rows").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: F.struct(F.least(other, F.col("block")).alias("lo"), F.greatest(other, F.col("block")).alias("hi")))
    groups = placed.withColumn("pair", F.explode(pairs)).select("leaf", "pair.lo", "pair.hi", "block", "node", "n", "embedding", "leaves")
    found = staged(groups.groupBy("leaf", "lo", "hi").applyInPandas(_compare(cosine), "node long, links long, root long"), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    labelled = nodes.join(links, "node", "left").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = staged(labelled, "labelled")
    smallest = labelled.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    labels = join_hot(labelled, smallest, ["component"]).select("embedding", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = join_hot(good, staged(labels, "labels"), ["embedding"], counted="n").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~(usable(F.col("embedding")) & F.col("vec_id").isNotNull())).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
