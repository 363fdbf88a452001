"""Op 9: documents whose sets of word 5-grams have a Jaccard similarity of 0.75 or more, and their groups.

A document's shingles are hashed into groups; the counts of the groups are a point. Two sets cannot share more than
the sum of the coordinate-wise minima, so an R-tree over the points prunes by the upper corners of its boxes, and only
surviving pairs are verified on the whole sets.

An R-tree over all documents at once would look at nearly every box of like size (points of random texts lie close
together), so the trees are built per block: a pair over the threshold shares one of the first n - ceil(0.75 n) + 1
shingles of either side in any fixed order (prefix filter, no loss). The order is: often seen shingles last. How often
is estimated from the data; a poor estimate costs time, never a pair.

1. Keys (prefix shingles) that two texts or more share are found by an aggregate (combined map-side). A block is all
   texts that share a key with the same pivot, the smallest text of that key; so a pair meets in few blocks.
2. Blocks get R-trees over the counts of their texts. A block over ``tile`` texts is cut into tiles. In the first round each text
   stays in its own tile, and a spanning forest of the pairs that survive the bound is verified; the second round does the
   same with one text of each component of a block of several tiles. What is left of a large group of near copies is then one
   component, at the cost of its size.
3. The third round takes all surviving pairs between different components. The texts of a block's largest component stay in their own
   tiles, and only its other texts are sent to all tiles: pairs inside a component cannot change it.
Vectors travel with the keys; whole sets are made again from the texts for surviving pairs alone.

Defined results: null text counts as empty, and a text without words is linked with nothing. Copies share a node and
so a component. Rows that repeat are kept one for one. A null doc_id takes part, but names a component only if the
component has no other id (then null). An empty table gives no rows. Other columns are not read.
Nodes and shingles are 64-bit hashes, so results are exact but for collisions (about pairs / 2^64).
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import Bitmap, Scratch, attach, bounded, caching, map_arrow, table, thrifty, union_all, utf8

_MULT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    """Hashes of words that this worker has met; emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        return h


_HASHES = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    caching(_HASHES.clear)
    return np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words)).view(np.uint64)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of ``n`` words; of the whole sequence if it is shorter. ``words`` isn't empty."""
    k = min(n, len(words))
    acc = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        acc = acc * _MULT + words[j : len(words) - k + 1 + j]
    acc = (acc ^ (acc >> np.uint64(32)) ^ np.uint64(k)) * _MIX
    return acc ^ (acc >> np.uint64(29))


def shingle_set(text: bytes, n: int = 5) -> np.ndarray:
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    return np.unique(windows(word_hashes(words), n)) if words else np.empty(0, np.uint64)


def node_of(shingles: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(shingles, digest_size=8).digest(), "little", signed=True)


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """Counts by group, one byte each. The bound is only sharp with few shingles in a group: two groups for
    a shingle in short texts, one for two in long ones, where chance evens out. Doubled until each count fits its byte."""
    groups = 1 << int(np.ceil(np.log2(max(2 * min(len(shingles), 256), len(shingles) / 2, 16))))
    while True:
        counts = np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        if counts.max(initial=0) < 256:
            return counts.astype(np.uint8)
        groups *= 2


def packed(vector: np.ndarray) -> bytes:
    """The counts as they travel: nearly all are 0, 1 or 2, which entropy coding makes a fifth of."""
    return zstandard.ZstdCompressor(level=1).compress(vector.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)


def fold(vector: np.ndarray, groups: int) -> np.ndarray:
    """The same counts over fewer groups (powers of two, by the low bits)."""
    return vector.reshape(-1, groups).sum(0, dtype=np.int32)


def band(n: np.ndarray) -> np.ndarray:
    """Size classes; sizes of linked texts are at most 4 : 3, so at most one class apart."""
    return np.floor(np.log(n) / np.log(4 / 3) + 1e-9).astype(np.int64)


def needed(a, b):
    """The least intersection of sets of these sizes at 100 * intersection >= 75 * union."""
    return -(-3 * (a + b) // 7)


class RTree:
    """Points packed in order of their first sums, 16 to a box and 16 boxes to the next; upper corners only."""

    FAN = 16

    def __init__(self, sizes: np.ndarray, points: np.ndarray):
        half = points.shape[1] // 2
        self.order = np.lexsort((points[:, :half].sum(1), sizes))
        self.sizes, self.points = sizes[self.order], points[self.order]
        self.levels = [(self.sizes, self.sizes, self.points)]
        while len(self.levels[-1][0]) > self.FAN:
            low, high, top = self.levels[-1]
            cuts = np.arange(0, len(low), self.FAN)
            self.levels.append((np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.maximum.reduceat(top, cuts)))

    def search(self, sizes: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) that the sizes and the summed minima don't rule out."""
        q, node = np.divmod(np.arange(len(sizes) * len(self.levels[-1][0])), len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            low, high, top = self.levels[depth]
            if depth < len(self.levels) - 1:
                q = np.repeat(q, self.FAN)
                node = (node[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                inside = node < len(low)
                q, node = q[inside], node[inside]
            fits = (4 * high[node] >= 3 * sizes[q]) & (3 * low[node] <= 4 * sizes[q])
            q, node = q[fits], node[fits]
            keep = [np.minimum(points[q[i : i + 4096]], top[node[i : i + 4096]]).sum(1) >= needed(sizes[q[i : i + 4096]], np.maximum(low[node[i : i + 4096]], -(-3 * sizes[q[i : i + 4096]] // 4))) for i in range(0, len(q), 4096)]
            keep = np.concatenate(keep) if keep else np.empty(0, bool)
            q, node = q[keep], node[keep]
        return q, self.order[node]


def _often(docs: DataFrame, k: int, chunk: int = 4_000_000, least: int = 3, most: int = 500_000) -> np.ndarray:
    """Shingles of many documents, the most frequent last: counted in chunks that hold them ``least`` times or more."""
    def count(batch):
        out, sets, held = [], [], 0
        texts = utf8(batch, "text")
        for i, text in enumerate(texts):
            sets.append(shingle_set(text, k))
            held += len(sets[-1])
            if held >= chunk or i == len(texts) - 1:
                h, c = np.unique(np.concatenate(sets), return_counts=True)
                out.append((h[c >= least], c[c >= least]))
                sets, held = [], 0
        return {"h": np.concatenate([h for h, _ in out]).view(np.int64), "c": np.concatenate([c for _, c in out])} if out else None

    top = (map_arrow(docs.select("text"), count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
           .orderBy(F.desc("c"), "h").limit(most).toArrow())
    return top.column("h").to_numpy()[::-1].astype(np.int64).view(np.uint64)


def _keyed(docs: DataFrame, often: np.ndarray, k: int) -> DataFrame:
    """A row per document: doc_id, body (hash of its text), node (hash of its set), n (size of the set), vec (its counts, packed), keys (its prefix)."""
    rank = docs.sparkSession.sparkContext.broadcast((np.sort(often), np.argsort(often)))

    def key(batch):
        common, place = rank.value
        nodes, sizes, vecs, keys = [], [], [], []
        for text in utf8(batch, "text"):
            s = shingle_set(text, k)
            nodes.append(node_of(s.tobytes()))
            sizes.append(len(s))
            vecs.append(packed(count_vector(s)))
            prefix = len(s) - -(-3 * len(s) // 4) + 1
            if len(common) and len(s):
                at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                met = common[at] == s
                s = np.concatenate([s[~met], s[met][np.argsort(place[at[met]], kind="stable")]])
            keys.append(s[:prefix].view(np.int64))
        return {"doc_id": batch.column("doc_id"), "body": batch.column("body"), "node": nodes, "n": sizes, "vec": vecs, "keys": keys}

    return map_arrow(docs.select("doc_id", body_hash().alias("body"), "text"), key, "doc_id long, body long, node long, n long, vec binary, keys array<long>")


def body_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _members(keyed: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, pivot): the blocks of each node. A bitmap sorts out most other keys before the shuffle."""
    bitmap = keyed.sparkSession.sparkContext.broadcast(Bitmap(shared.select("key"), bits=27))

    def sieve(batch):
        keys = batch.column("keys")
        flat, lengths = keys.flatten().to_numpy(), np.diff(keys.offsets.to_numpy())
        met = bitmap.value.has(flat)
        return {"node": np.repeat(batch.column("node").to_numpy(), lengths)[met], "key": flat[met]}

    met = map_arrow(keyed.select("node", "keys"), sieve, "node long, key long")
    return met.join(shared, "key").select("node", "pivot").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, keyed: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets, made from the texts again."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    reps = keyed.select("node", "doc_id").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    bitmap = docs.sparkSession.sparkContext.broadcast(Bitmap(reps.select(F.xxhash64("doc_id"))))

    def make(batch):
        met = np.flatnonzero(bitmap.value.has(batch.column("h").to_numpy()))
        if not len(met):
            return None
        sets = [shingle_set(x, k).tobytes() for x in utf8(batch.take(met), "text")]
        return {"doc_id": batch.column("doc_id").take(met), "node": [node_of(x) for x in sets], "shingles": sets}

    made = map_arrow(docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")), make, "doc_id long, node long, shingles binary")
    # A text that repeats with its doc_id is taken once; another text with the same doc_id has another node.
    sets = (made.join(reps.select("node", F.col("doc_id").alias("rep")), "node").where(F.col("doc_id").eqNullSafe(F.col("rep")))
            .select("node", "shingles").dropDuplicates(["node"]))
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))

    def check(batch):
        a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb"))
        ok = [i for i in range(len(a)) if len(np.intersect1d(np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64), assume_unique=True))
              >= needed(len(x[i]) // 8, len(y[i]) // 8)]
        return {"a": [a[i] for i in ok], "b": [b[i] for i in ok]}

    return map_arrow(pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "sb"), check, "a long, b long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp) of all nodes with an edge (a, b); comp is one node of the component.

    Every node goes to its smallest neighbour's smallest neighbour, the edges are drawn anew between where their ends
    have gone, and those inside one place fall away: the edges shrink from round to round.
    """
    labels, here = None, scratch.keep(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    while True:
        to = here.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("to"))
        jump = to.select(F.col("node").alias("to"), F.col("to").alias("far"))
        to = scratch.keep(to.join(jump, "to").select("node", F.least("to", "far").alias("comp")))
        if labels is None:
            labels = to
        else:
            moved = to.select(F.col("node").alias("comp"), F.col("comp").alias("moved"))
            labels = scratch.keep(labels.join(moved, "comp", "left").select("node", F.coalesce("moved", "comp").alias("comp")))
        ends = (here.join(to.select(F.col("node").alias("a"), F.col("comp").alias("x")), "a")
                .join(to.select(F.col("node").alias("b"), F.col("comp").alias("y")), "b"))
        here = scratch.keep(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if here.isEmpty():
            return labels


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs make a spanning forest, in their order."""
    root: dict[int, int] = {}
    keep = np.zeros(len(a), bool)

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)], keep[i] = min(x, y), True
    return keep


def _dealt(members: DataFrame, vectors: DataFrame, tile: int, across: bool) -> DataFrame:
    """Rows of blocks, members (pivot, node, comp, n), at their tiles: each in its own, and, ``across``, those outside a block's largest
    component in all of them."""
    # Rows of a block without a row of another component near their size leave before the vectors come in.
    classes = members.withColumn("class", F.floor(F.log("n") / float(np.log(4 / 3)) + 1e-9))
    wide = (classes.withColumn("class", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)))
            .groupBy("pivot", "class").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("pivot", "class"))
    near = classes.join(wide, ["pivot", "class"]).drop("class")
    per_comp = near.groupBy("pivot", "comp").agg(F.count(F.lit(1)).alias("c"))
    sizes = per_comp.groupBy("pivot").agg(
        F.ceil(F.sum("c") / tile).cast("int").alias("tiles"), F.max(F.struct("c", "comp"))["comp"].alias("main"))
    # Without a second tile there is nothing to deal; a row of the block's largest component is never sent to others' tiles.
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    placed = near.join(sizes, "pivot").withColumn("own", own)
    if across:
        away = F.when(F.col("comp") != F.col("main"), F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("own"))
        placed = placed.withColumn("at", F.explode(away))
    else:
        placed = placed.withColumn("at", F.col("own"))
    return placed.join(vectors.select("node", "vec"), "node").select(
        F.col("pivot").alias("key"), "at", (F.col("own") == F.col("at")).alias("home"), "node", "comp", "n", "vec")


def _block_pairs(dealt: DataFrame, forest: bool) -> DataFrame:
    """Pairs of different components that the R-trees of the tiles let through, or a ``forest`` of them in each tile."""
    def block(rows: list) -> tuple[np.ndarray, np.ndarray]:
        node, comp, n, home = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 3))
        vecs = [unpacked(r[4]) for r in rows]
        classes, out = band(n), [(node[:0], node[:0])]
        for c in np.unique(classes):
            queries, points = np.flatnonzero(classes == c), np.flatnonzero((classes == c) | (classes == c + 1))
            if len(points) < 2 or (comp[points] == comp[points[0]]).all():
                continue
            m = min(len(vecs[x]) for x in points)
            folded = np.stack([fold(vecs[x], m) for x in points])
            tree, asked = RTree(n[points], folded), np.searchsorted(points, queries)
            for x in range(0, len(queries), 128):
                q, p = tree.search(n[queries[x : x + 128]], folded[asked[x : x + 128]])
                q, p = queries[q + x], points[p]
                # Two visitors meet in their own tiles as well.
                ok = (comp[q] != comp[p]) & ((home[q] | home[p]) == 1) & ((classes[p] > c) | (node[q] < node[p]))
                a, b = np.minimum(node[q], node[p])[ok], np.maximum(node[q], node[p])[ok]
                keep = _forest(a, b) if forest else slice(None)
                out.append((a[keep], b[keep]))
        a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        keep = _forest(a, b) if forest else slice(None)
        return a[keep], b[keep]

    def run(batches):
        import pyarrow as pa

        held, at = [], None
        out_a, out_b = [], []

        def close():
            if len(held) > 1:
                a, b = block(held)
                out_a.append(a)
                out_b.append(b)
            held.clear()

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("node", "comp", "n", "home", "vec", "key", "at")]
            for row in zip(*cols, strict=True):
                if row[5:] != at:
                    close()
                    at = row[5:]
                held.append(row)
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out_a, out_b)], ["a", "b"])
                out_a.clear(), out_b.clear()
        close()
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out_a, out_b)], ["a", "b"])

    return bounded(dealt.repartition("key", "at").sortWithinPartitions("key", "at")).mapInArrow(thrifty(run), "a long, b long").distinct()


def components_of(docs: DataFrame, n: int = 5, tile: int = 1_000) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, body (hash of its text), n (size of its set), comp (null for rows without words)."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    keyed = scratch.keep(_keyed(docs, _often(docs, n), n))
    rows = scratch.keep(keyed.select("doc_id", "body", "n", "node"))
    keys = keyed.where("n > 0").select("node", F.explode("keys").alias("key"))
    shared = scratch.keep(keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
                          .where("pivot <> last").select("key", "pivot"))
    members = scratch.keep(_members(keyed, shared))
    vectors = scratch.keep(keyed.join(members.select("node").distinct(), "node", "left_semi").select("node", "n", "vec").dropDuplicates(["node"]))
    scratch.release(keyed, shared)
    blocks = scratch.keep(members.join(vectors.select("node", "n"), "node"))
    scratch.release(members)
    # Only blocks of several tiles need the round of representatives.
    large = scratch.keep(blocks.groupBy("pivot").count().where(F.col("count") > tile).select("pivot"))
    links, comps = [], None
    for reps, across in ((False, False), (True, False), (False, True)):
        if reps and large.isEmpty():
            continue
        here = blocks.withColumn("comp", F.col("node")) if comps is None else blocks.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        if reps:
            here = here.join(large, "pivot", "left_semi").groupBy("pivot", "comp").agg(F.min(F.struct("node", "n")).alias("least")).select("pivot", "comp", "least.node", "least.n")
        pairs = scratch.keep(_block_pairs(_dealt(here, vectors, tile, across), not across))
        if not pairs.isEmpty():
            links.append(scratch.keep(_verified(pairs, docs, rows, n)))
            comps = components(union_all(links), scratch)
        scratch.release(pairs)
    scratch.release(vectors, blocks)
    if comps is None:
        return rows.select("doc_id", "body", "n", F.when(F.col("n") > 0, F.col("node")).alias("comp"))
    linked = scratch.keep(rows.groupBy("node").agg(F.count(F.lit(1)).alias("c")).join(comps, "node"))
    placed = attach(rows, linked, "node", "c", "left").withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "node")))
    return scratch.keep(placed.select("doc_id", "body", "n", "comp"))


def ngram_join(docs: DataFrame, n: int = 5, tile: int = 1_000) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id. See the module's text."""
    rows = components_of(docs, n, tile)
    names = Scratch(docs.sparkSession).keep(
        rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("c")))
    worded = attach(rows.where("comp IS NOT NULL"), names, "comp", "c").select("doc_id", "n", "first_id")
    return worded.unionByName(rows.where("comp IS NULL").select("doc_id", "n", F.col("doc_id").alias("first_id"))).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("first_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, tile: int = 1_000) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id (null last, then by a hash of the text), and all
    without words. Rows equal in doc_id and text stay or go together; take exact copies out before."""
    scratch = Scratch(docs.sparkSession)
    rows = components_of(docs, n, tile)
    row = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "body")
    first = rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min(row).alias("first")).select("first.doc_id", "first.body")
    stay = scratch.keep(first.unionByName(rows.where("comp IS NULL").select("doc_id", "body")).distinct())
    named = stay.select(F.coalesce("doc_id", F.lit(0)).alias("_i"), F.col("doc_id").isNull().alias("_null"), F.col("body").alias("_body"))
    return docs.join(named, (F.coalesce(F.col("doc_id"), F.lit(0)) == F.col("_i")) & (F.col("doc_id").isNull() == F.col("_null"))
                     & (body_hash() == F.col("_body")), "left_semi")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with the size of its shingle set and its component."""
    return ngram_join(table(spark, sf_dir, "documents"))
