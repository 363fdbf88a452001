"""Op 13: near copies by SimHash fingerprints (64 bits) that differ in at most ``MOST`` bits, found in vantage-point trees.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it (4 words, A-Z lowered, XXH64 with
seed 42, repeats count each time). Copies share a fingerprint, so the search runs over the distinct ones.

Sharding. Two fingerprints within 4 bits are within 1 bit on one of three thirds of their bits, so there is a tree per third. A
level of a tree partitions by the Hamming distance to a vantage point on a piece of that third. Distances on disjoint
pieces add up, so by the triangle inequality a fingerprint within 1 bit lies in a shard whose distances differ from its own by 1
in all: every fingerprint lives in one shard of each tree and also asks the shards on its boundary (those one lower at one
level; the others ask it). Levels are added until the largest shard holds ``shard_rows`` fingerprints: a copy per level at
most is sent, whatever the size of the table.

Inside a shard a vantage-point tree over whole fingerprints is built and asked in one descent: points split at the median distance to
a vantage point, questions go where the triangle inequality lets a partner within 4 bits be. Distances are exact. Questions
that are already linked with all points of a branch skip it, so a dense group of near copies costs about its size and
yields a forest of links, never all its pairs. A task holds one shard, 8 bytes a fingerprint.

Defined results: null text counts as empty; without words the fingerprint is zero, linked like any other. Rows that repeat are kept one
for one. A null doc_id takes part, but names a component only if the component has no other id (then null). An empty table
gives no rows. A very long text is hashed in chunks of shingles. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import Scratch, attach, bounded, map_arrow, table, thrifty, union_all, utf8
from asofkit.llm.ngram_join import components

MOST = 4
#: With three trees MOST // 3 = 1 is the radius on at least one tree's bits, which is what ``dealt`` asks for.
TREES = 3
#: Bits of each tree, and the numbers of levels that they can be cut into.
PARTS = [list(map(int, part)) for part in np.array_split(np.arange(64), TREES)]
LEVELS = (1, 3, 7, 21)
LEAF = 1 << 16


def fingerprint(text: bytes, n: int = 4, chunk: int = 1 << 16) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    k, joined = min(n, len(words)), b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[: len(words) - k + 1], ends[k - 1 :]
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), chunk):
        spans = zip(first[at : at + chunk].tolist(), last[at : at + chunk].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(first), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 4) -> DataFrame:
    """(doc_id, fp) of every row."""
    def run(batch):
        return {"doc_id": batch.column("i"), "fp": np.fromiter((fingerprint(t, n) for t in utf8(batch, "t")), np.int64, batch.num_rows)}

    return map_arrow(docs.select(F.col(id).alias("i"), F.col(text).alias("t")), run, "doc_id long, fp long")


def far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


class Links:
    """Which fingerprints of a shard are linked so far: a label each, and the links that made it so."""

    def __init__(self, n: int):
        self.label, self.made = np.arange(n), []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        apart = self.label[x] != self.label[y]
        if not apart.any():
            return
        root: dict[int, int] = {}

        def find(k: int) -> int:
            while root.setdefault(k, k) != k:
                root[k] = k = root[root[k]]
            return k

        for i, j in zip(x[apart].tolist(), y[apart].tolist(), strict=True):
            a, b = find(int(self.label[i])), find(int(self.label[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                self.made.append((i, j))
        to = np.arange(len(self.label))
        for k in list(root):
            to[k] = find(k)
        self.label = to[self.label]

    def leaf(self, fp: np.ndarray, points: np.ndarray, asked: np.ndarray) -> None:
        """All questions against all points; of those still apart one link per question at a time."""
        step = max(1, LEAF // len(points))
        for at in range(0, len(asked), step):
            q = asked[at : at + step]
            near = far(fp[points][:, None], fp[q][None, :]) <= MOST
            while True:
                apart = near & (self.label[points][:, None] != self.label[q][None, :])
                met = np.flatnonzero(apart.any(0))
                if not len(met):
                    break
                self.add(points[apart[:, met].argmax(0)], q[met])

    def search(self, fp: np.ndarray, home: int) -> None:
        """Link what is within MOST bits; the first ``home`` of ``fp`` are the shard's points, all of ``fp`` are questions."""
        stack = [(np.arange(home), np.arange(len(fp)))]
        while stack:
            points, asked = stack.pop()
            own = self.label[points]
            if (own == own[0]).all():
                asked = asked[self.label[asked] != own[0]]
            if not len(asked):
                continue
            if len(points) <= 32 or len(points) * len(asked) <= LEAF:
                self.leaf(fp, points, asked)
                continue
            v = points[len(points) // 2]
            d = far(fp[v], fp[points])
            mu = float(np.median(d))
            if d.max() <= mu:  # the median is the largest distance: the split is below it
                mu = float(d[d < d.max()].max())  # the vantage point itself is at 0, so there is one
            dq = far(fp[v], fp[asked])
            close = asked[(dq <= MOST) & (asked != v)]
            self.add(np.full(len(close), v), close)
            stack.append((points[d <= mu], asked[dq <= mu + MOST]))
            stack.append((points[d > mu], asked[dq > mu - MOST]))


def _pieces(part: list[int], levels: int) -> list[list[int]]:
    return [p.tolist() for p in np.array_split(part, min(levels, len(part)))]


def _distances(vantage: int, tree: int, levels: int) -> list[Column]:
    """Distance of ``fp`` to the vantage point on each piece of the tree's bits."""
    masks = [sum(1 << b for b in piece) for piece in _pieces(PARTS[tree], levels)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return [F.bit_count(F.col("fp").bitwiseXOR(F.lit(vantage)).bitwiseAND(F.lit(m))) for m in signed]


def _shard(distances: list[Column], bits: int) -> Column:
    at = F.lit(0).cast("long")
    for d in distances:
        at = at * (bits + 1) + d
    return at


def _width(tree: int, levels: int) -> int:
    return max(map(len, _pieces(PARTS[tree], levels)))


def largest_shard(distinct: DataFrame, vantage: int, levels: int) -> int:
    per_tree = [distinct.groupBy(_shard(_distances(vantage, t, levels), _width(t, levels)).alias("s")).count() for t in range(TREES)]
    return union_all([p.select("count") for p in per_tree]).agg(F.max("count")).first()[0] or 0


def dealt(distinct: DataFrame, vantage: int, levels: int) -> DataFrame:
    """(tree, shard, asks, fp): each fingerprint at home once per tree, and as a question to the shards one lower at one level."""
    out = []
    for t in range(TREES):
        distances, width = _distances(vantage, t, levels), _width(t, levels)
        home = _shard(distances, width)
        one = [(width + 1) ** (len(distances) - 1 - j) for j in range(len(distances))]
        lower = [F.when(d > 0, F.struct((home - s).alias("shard"), F.lit(True).alias("asks"))) for d, s in zip(distances, one, strict=True)]
        seats = F.array_compact(F.array(F.struct(home.alias("shard"), F.lit(False).alias("asks")), *lower))
        out.append(distinct.select(F.lit(t).alias("tree"), "fp", F.explode(seats).alias("seat")).select("tree", "seat.shard", "seat.asks", "fp"))
    return union_all(out)


def links(seats: DataFrame) -> DataFrame:
    """A forest of links (a, b) of each shard."""
    def run(batches):
        key, held = None, []

        def close():
            fp, asks = (np.concatenate(x) for x in zip(*held, strict=True))
            home = len(fp) - int(asks.sum())
            if not home or len(fp) < 2:
                return []
            made = Links(len(fp))
            made.search(fp, home)
            return [(int(fp[i]), int(fp[j])) for i, j in made.made]

        for batch in batches:
            tree, shard, asks, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "shard", "asks", "fp"))
            cuts = np.flatnonzero((np.diff(tree) != 0) | (np.diff(shard) != 0)) + 1
            pairs: list[tuple[int, int]] = []
            for lo, hi in zip([0, *cuts], [*cuts, len(fp)], strict=True):
                if lo == hi:
                    continue
                here = (tree[lo], shard[lo])
                if here != key:
                    if held:
                        pairs += close()
                    key, held = here, []
                held.append((fp[lo:hi].copy(), asks[lo:hi].copy()))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], ["a", "b"])
        pairs = close() if held else []
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], ["a", "b"])

    sharded = seats.repartition("tree", "shard").sortWithinPartitions("tree", "shard", "asks", "fp")
    found = bounded(sharded).mapInArrow(thrifty(run), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def simhash_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 4, shard_rows: int = 8_192) -> DataFrame:
    """A row per row of ``docs``: doc_id, fp (signed), component_id. See the module's text."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(fingerprints(docs, id, text, n))
    distinct = scratch.keep(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id")))
    vantage = distinct.orderBy(F.xxhash64("fp"), "fp").select("fp").first()
    if vantage is None:
        return rows.select("doc_id", "fp", F.col("doc_id").alias("component_id"))
    levels = next((x for x in LEVELS if largest_shard(distinct, vantage[0], x) <= shard_rows), LEVELS[-1])
    found = scratch.keep(links(dealt(distinct.select("fp"), vantage[0], levels)))
    placed = distinct
    if not found.isEmpty():
        comps = scratch.keep(components(found, scratch).select(F.col("node").alias("fp"), "comp"))
        linked = scratch.keep(distinct.join(comps, "fp"))
        names = scratch.keep(linked.groupBy("comp").agg(F.count(F.lit(1)).alias("fps"), F.min("first_id").alias("component_id")))
        named = attach(linked.select("fp", "comp"), names, "comp", "fps").select("fp", "component_id")
        placed = distinct.join(named, "fp", "left").withColumn("first_id", F.coalesce("component_id", "first_id"))
    ids = scratch.keep(placed.select("fp", "rows", F.col("first_id").alias("component_id")))
    return attach(rows, ids, "fp", "rows").select("doc_id", "fp", "component_id")


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its fingerprint and its component."""
    found = simhash_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
