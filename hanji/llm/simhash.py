"""SimHash near-duplicates, found through tables of Hamming distances to reference fingerprints."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import connected_components, join_hot, marked, staged

#: Words in a shingle, the hash's seed, and the number of differing bits up to which fingerprints link.
SHINGLE, HASH_SEED, RADIUS = 3, 42, 2
#: The 64 bits in four blocks; references for each pair of blocks; and references for whole fingerprints.
BLOCKS, PER_PAIR, WHOLE = 4, 16, 24
#: Fingerprints in one distance table, on average; a larger bucket is cut into such blocks.
TABLE_ROWS = 4096
#: For links by counted similarity: smallest shingle hashes that name a document's buckets, differing bits (of 128) up to
#: which a pair is counted, references that a bucket takes from its own fingerprints, and shingles in a block.
ANCHORS, WIDE, OWN, BLOCK_SHINGLES = 6, 38, 8, 1 << 19


def references(n: int, seed: int) -> list[int]:
    rng = random.Random(seed)
    return [rng.getrandbits(64) for _ in range(n)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of all shingles. Fewer words than a shingle has: the whole sequence is the one shingle."""
    if not words:
        return np.empty(0, dtype="<u8")
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest, seed = xxhash.xxh64_intdigest, HASH_SEED
    return np.array([digest(s, seed) for s in shingles], dtype="<u8")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # on bytes, both know ASCII only


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes. No words (null and empty texts too): zero."""
    return majority(shingle_hashes(words_of(text), shingle))


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def second_half(hashes: np.ndarray) -> np.ndarray:
    """64 more bits of each hash."""
    h = (hashes ^ hashes >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        values = pa.array([signed(fingerprint(texts[i].as_py())) for i in range(len(texts))], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "fp"])


def near_pairs(fps: np.ndarray, refs: np.ndarray, radius: int, labels: np.ndarray, sides: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i > j, of fingerprints (rows of 64-bit words) that differ in `radius` bits at most and have
    different labels when a step begins, ordered by i and, for each, its nearest j first.

    The table holds every fingerprint's Hamming distances to the references. By the triangle inequality the distances of
    a near pair to any reference differ by `radius` at most, so pairs whose largest coordinate difference is greater are
    discarded, and what survives is compared itself. Pairs of one side (other than 0) are not asked for.
    """
    table = np.bitwise_count(fps[:, None] ^ refs[None]).sum(axis=2, dtype=np.int16)
    for at in range(0, len(fps), 256):
        end = min(at + 256, len(fps))
        ok = np.tri(end - at, end, at - 1, dtype=bool)
        ok &= labels[at:end, None] != labels[None, :end]
        ok &= (sides[at:end, None] == 0) | (sides[at:end, None] != sides[None, :end])
        for c in range(table.shape[1]):
            ok &= np.abs(table[at:end, None, c] - table[None, :end, c]) <= radius
        i, j = np.nonzero(ok)
        i += at
        bits = np.bitwise_count(fps[i] ^ fps[j]).sum(axis=1)
        keep = bits <= radius
        i, j = i[keep], j[keep]
        order = np.lexsort((bits[keep], i))
        yield i[order], j[order]


def joining_links(nodes: np.ndarray, labels: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]], holds: Callable[[int, int], bool]) -> pa.RecordBatch:
    """Links (a, b) of those pairs that hold and join two labels, in turn; a pair that links join already isn't tried."""
    a, b = [], []
    for i, j in pairs:
        firsts = np.flatnonzero(np.diff(i, prepend=-1))
        for x, others in zip(i[firsts].tolist(), np.split(j, firsts[1:]) if len(i) else [], strict=True):
            others = others[labels[others] != labels[x]]
            while len(others):
                y, others = int(others[0]), others[1:]
                if holds(x, y):
                    a.append(nodes[x])
                    b.append(nodes[y])
                    labels[labels == labels[x]] = labels[y]
                    others = others[labels[others] != labels[x]]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in order of `run` -> a batch for each run that has two rows or more, whatever batches it spans."""
    held, held_run = [], None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column("run").to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        # A lone row may have company only in the batch before or after.
        for k in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(keys))).tolist():
            if keys[starts[k]] != held_run:
                if sum(map(len, held)) > 1:
                    yield pa.concat_batches(held)
                held, held_run = [], keys[starts[k]]
            held.append(batch.slice(starts[k], ends[k] - starts[k]))
    if sum(map(len, held)) > 1:
        yield pa.concat_batches(held)


def links_in_blocks(members: DataFrame, weight: str, limit: int, links_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stored members (key, blocks, node, ...) of buckets -> links (a, b) that leave the same components as all links
    between members of equal keys.

    links_of gets the members with run, label and side, and finds links between rows of one run that have different
    labels and not the same side (0: both sides). First every bucket is cut by hash into blocks, which are linked each by
    itself; buckets that share members are cut differently, so a large group of copies holds together afterwards. Then, in
    buckets of several blocks, the members of the label with most members are the core. Pairs inside the core are linked
    already; what is outside is held against all members of the bucket, block by block in chunks, so a run never exceeds
    two blocks and a hot bucket costs its members times those outside its core.
    """
    block = F.pmod(F.xxhash64("key", "node"), F.col("blocks"))
    inside = members.withColumns({"run": F.xxhash64("key", block), "label": F.col("node"), "side": F.lit(0)})
    links = staged(links_of(inside), "links")
    wide = members.filter("blocks > 1")
    if wide.isEmpty():
        return links
    labels = connected_components(links).select("node", F.col("component").alias("label"))
    wide = staged(wide.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "wide")
    groups = staged(wide.groupBy("key", "label").agg(F.count("*").alias("rows"), F.sum(weight).alias("weight")), "groups")
    core = groups.groupBy("key").agg(F.max(F.struct("rows", "label", "weight")).alias("core"), F.sum("weight").alias("all"), F.sum("rows").alias("rows"))
    chunks = F.ceil((F.col("all") - F.col("core.weight")) / limit)
    core = staged(core.select("key", F.col("core.label").alias("core"), chunks.alias("chunks"), "rows").filter("chunks > 0"), "cores")
    open_ = staged(join_hot(wide, core, ["key"], counted="rows"), "open")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    home = open_.withColumn("chunk", upto("chunks")).withColumns({"run": F.xxhash64("key", block, "chunk"), "side": F.lit(1)})
    asked = open_.filter("label <> core").withColumn("block", upto("blocks"))
    asked = asked.withColumns({"run": F.xxhash64("key", "block", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("chunks"))), "side": F.lit(2)})
    again = staged(links_of(home.drop("chunk").unionByName(asked.drop("block"))), "links")
    return links.unionByName(again)


def bucket_members(keyed: DataFrame, weight: str, limit: int) -> DataFrame:
    """keyed (key, node, ...) -> stored members of the buckets with two rows or more, with their number of blocks."""
    blocks = F.ceil(F.greatest(F.sum(weight) / limit, F.count("*") / TABLE_ROWS))
    buckets = staged(keyed.groupBy("key").agg(F.count("*").alias("rows"), blocks.alias("blocks")).filter("rows > 1"), "buckets")
    return staged(join_hot(keyed, buckets, ["key"], counted="rows").drop("rows"), "members")


def _near_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    refs = np.array(references(WHOLE, 1), np.uint64)[:, None]
    for run in runs_of(batches):
        nodes, labels, sides = (run.column(c).to_numpy() for c in ("node", "label", "side"))
        labels = np.unique(labels, return_inverse=True)[1]
        yield joining_links(nodes, labels, near_pairs(nodes.view(np.uint64)[:, None], refs, RADIUS, labels, sides), lambda x, y: True)


def fingerprint_links(distinct: DataFrame, table_rows: int = TABLE_ROWS) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) that leave the same components as all pairs within RADIUS bits.

    Two fingerprints that differ in two bits agree on at least two of the four blocks of bits, so within those blocks they
    have the same distance to every reference. Each fingerprint therefore enters one bucket for each of the six pairs of
    blocks, named by its PER_PAIR distances inside that pair; members of a bucket are compared through the table of their
    whole distances (near_pairs), `table_rows` at a time (links_in_blocks).
    """
    width = 64 // BLOCKS
    keys = []
    for n, pair in enumerate(combinations(range(BLOCKS), 2)):
        mask = sum(((1 << width) - 1) << (b * width) for b in pair)
        near = [F.bit_count((F.col("fp").bitwiseXOR(F.lit(signed(r)))).bitwiseAND(F.lit(signed(mask)))) for r in references(PER_PAIR, 100 + n)]
        keys.append(F.xxhash64(F.lit(n), *near))
    keyed = distinct.select(F.col("fp").alias("node"), F.lit(1).alias("one"), F.explode(F.array(*keys)).alias("key"))
    members = bucket_members(keyed, "one", table_rows)

    def links_of(rows: DataFrame) -> DataFrame:
        runs = rows.select("run", "node", "label", "side").repartition("run").sortWithinPartitions("run", "node")
        return runs.mapInArrow(_near_links, "a long, b long")

    return links_in_blocks(members, "one", table_rows, links_of)


def simhash_components(docs: DataFrame, table_rows: int = TABLE_ROWS) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that a document reaches over links, itself included. Equal fingerprints, zero
    too, are one node of the graph, so copies are never expanded into pairs. Null and empty texts have fingerprint
    zero; a null doc_id is no candidate for smallest; repeated rows give repeated rows; other columns are ignored.
    """
    rows = staged(docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "distinct")
    nodes = connected_components(fingerprint_links(distinct.select("fp"), table_rows)).withColumnRenamed("node", "fp")
    linked = staged(distinct.join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "linked")
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = staged(join_hot(linked, smallest, ["component"]).select("fp", "component_id", "copies"), "component-ids")
    found = join_hot(rows, ids, ["fp"], counted="copies")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def node_of(words: list[bytes]) -> int:
    """One number for all texts of equal words in equal order."""
    return signed(xxhash.xxh3_64_intdigest(b" ".join(words)))


SKETCH = "node long, fp0 long, fp1 long, n long, anchors array<long>"


def _sketches(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, ...) -> instead of the text node (the hash of all words in order), a fingerprint of 128 bits of the distinct
    shingles, their number n and the smallest of their hashes."""
    for batch in batches:
        for part in tokens.portions(batch):
            columns = [[] for _ in range(5)]
            for text in tokens.texts_of(part):
                words = words_of(text)
                hashes = np.unique(shingle_hashes(words, shingle))
                own = (node_of(words), signed(majority(hashes)), signed(majority(second_half(hashes))), len(hashes), hashes[:ANCHORS].astype(np.int64))
                for column, value in zip(columns, own, strict=True):
                    column.append(value)
            out = part.drop_columns(["text"])
            for name, values in zip(("node", "fp0", "fp1", "n", "anchors"), columns, strict=True):
                out = out.append_column(name, pa.array(values, pa.list_(pa.int64()) if name == "anchors" else pa.int64()))
            yield out


def _sets(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> node, shingles: the sorted distinct hashes."""
    for batch in batches:
        for part in tokens.portions(batch):
            words = [words_of(text) for text in tokens.texts_of(part)]
            sets = [np.unique(shingle_hashes(w, shingle)).astype(np.int64) for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, words), pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def candidates(run: pa.RecordBatch, radius: int, similarity: float, labels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """near_pairs of a run of sketches, of sizes that allow the similarity, and with no smaller anchor in common (a pair
    is left to the bucket of its smallest common anchor)."""
    fps = np.stack([run.column("fp0").to_numpy(), run.column("fp1").to_numpy()], axis=1).view(np.uint64)
    refs = fps[np.linspace(0, len(fps) - 1, min(OWN, len(fps))).astype(int)]
    sizes, keys = run.column("n").to_numpy(), run.column("key").to_numpy().view(np.uint64)
    lengths = np.diff(run.column("anchors").offsets.to_numpy())
    # Only what is smaller than the key decides; the key itself fills the rest.
    anchors = np.repeat(keys[:, None], ANCHORS, axis=1)
    anchors[np.arange(ANCHORS) < lengths[:, None]] = run.column("anchors").flatten().to_numpy().view(np.uint64)
    anchors = np.minimum(anchors, keys[:, None])
    for i, j in near_pairs(fps, refs, radius, labels, run.column("side").to_numpy()):
        keep = np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j])
        i, j = i[keep], j[keep]
        keep = np.ones(len(i), bool)
        for a in range(ANCHORS):
            own = anchors[i, a]
            keep &= (own == keys[i]) | (anchors[j] != own[:, None]).all(axis=1)
        yield i[keep], j[keep]


def _partners(radius: int, similarity: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sketches -> the rows that have a possible partner in their run."""
    for run in runs_of(batches):
        some = np.zeros(len(run), bool)
        for i, j in candidates(run, radius, similarity, np.unique(run.column("label").to_numpy(), return_inverse=True)[1]):
            some[i] = some[j] = True
        if some.any():
            yield run.filter(pa.array(some))


def _similar(radius: int, similarity: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sketches with shingles -> links of nodes whose similarity was counted from both whole sets."""
    for run in runs_of(batches):
        column = run.column("shingles")
        flat, bounds = column.flatten().to_numpy(), column.offsets.to_numpy()
        bounds = bounds - bounds[0]

        def alike(x: int, y: int) -> bool:
            a, b = (flat[bounds[k] : bounds[k + 1]].view(np.uint64) for k in (x, y))  # noqa: B023
            common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            return common >= similarity * (len(a) + len(b) - common)

        labels = np.unique(run.column("label").to_numpy(), return_inverse=True)[1]
        yield joining_links(run.column("node").to_numpy(), labels, candidates(run, radius, similarity, labels), alike)


def similar_components(docs: DataFrame, shingle: int = 5, radius: int = WIDE, similarity: float = 0.8, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Stored documents (number, doc_id, text, ...) -> number, doc_id, component: the same for documents that links join,
    of texts whose sets of shingles have a Jaccard similarity of `similarity` at least. number is a row's own, and stored.

    Fingerprints that far apart share no block of bits, so the buckets come from the shingles: a document enters one for
    each of the ANCHORS smallest hashes of its shingles. Of two texts as similar as 0.8 each of the smallest hashes of
    their union is in both with chance 0.8, so they meet nowhere with chance 0.2 ** ANCHORS. In a bucket the pairs within
    `radius` of 128 bits survive the distance table and the comparison (unrelated fingerprints differ in 64 bits, texts
    of similarity 0.8 in about 20), and such a pair links only if the similarity counted from both whole sets is reached.
    Texts of equal words are one node. Blocks hold about `block_shingles` shingles (links_in_blocks); only rows with a
    possible partner get their shingles at all.
    """
    rows = staged(docs.select("number", "doc_id", "text").mapInArrow(partial(_sketches, shingle), f"number long, doc_id long, {SKETCH}"), "sketches")
    first = F.min(F.struct("number", "fp0", "fp1", "n", "anchors")).alias("x")
    distinct = staged(rows.groupBy("node").agg(first).select("node", "x.*"), "distinct")
    # Buckets are made of nodes alone; whole sketches move once, for members of buckets that have two or more.
    members = bucket_members(distinct.select("node", "n", F.explode("anchors").alias("key")), "n", block_shingles)
    sketches = distinct.select("node", "fp0", "fp1", "anchors")
    kept = ["run", "key", "label", "side", "node", "fp0", "fp1", "n", "anchors"]
    schema = f"run long, key long, label long, side int, {SKETCH}"

    def links_of(rows: DataFrame) -> DataFrame:
        runs = rows.join(sketches, "node").select(kept).repartition("run").sortWithinPartitions("run", "node")
        partners = staged(runs.mapInArrow(partial(_partners, radius, similarity), schema), "partners")
        wanted = distinct.select("node", "number").join(partners.select("node").distinct(), "node", "left_semi").select("number")
        texts = marked(docs.select("number", "text"), wanted, "number").filter("marked").select("text")
        sets = staged(texts.mapInArrow(partial(_sets, shingle), "node long, shingles array<long>"), "sets")
        full = partners.join(sets, "node").select(*kept, "shingles").repartition("run").sortWithinPartitions("run", "node")
        return full.mapInArrow(partial(_similar, radius, similarity), "a long, b long")

    nodes = connected_components(links_in_blocks(members, "n", block_shingles, links_of))
    return rows.join(nodes, "node", "left").select("number", "doc_id", F.coalesce("component", "node").alias("component"))
