"""Op 12: the prefix tree of conversations, by a burst trie.

A turn is 20 bytes: a digest of role and text (MD5) and the text's length in code points. A conversation is the string of its
turns; equal ones are one sequence with a count. Sequences lie in containers, each under a trie head (the path to it).

1. The root's container holds all. A container over ``most`` sequences bursts: the turns that all of it share are taken
   into the trie at once (the common prefix of its least and greatest sequence), and the next turn's id parts it into new
   containers one level below. Counts, minima and maxima are combined before the shuffle, so a first turn that a third of all
   conversations share is a row per task. Bursting goes on while a container is too large; distinct sequences part in the end.
2. Containers are dealt to shards by their path, sorted, and swept: neighbours' common prefix closes and opens nodes on a
   stack, so a task holds one path of open nodes and what is closed below it, of one container.
3. Heads are added up from the deepest burst to the root.

The ids of equal conversations are hashed in order: range-sorted, joined into pieces of ``piece`` ids, and the pieces of a
sequence fed to one hash.

Defined results: null role or text counts as empty. Turns of a conversation are ordered by turn (null first), those of one turn by their
digest. Rows that repeat are turns of their own. A null conv_id is a conversation of its own that takes no other's turns; it
is last in order, names a node only if no other member does (then null), and is written as the empty text in the hash. An empty
table has no conversation, so no node. Very long texts count by their length alone. A conversation travels as 20 bytes a turn in one row.
Other columns are not read. Digests of 128 bits take equal turns for equal; results are exact but for their collisions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import CRC_TABLE_SQL, Scratch, attach, crc_sql, map_arrow, map_rows, table, union_all

#: Bytes of a turn: its digest, and its length.
UNIT, DIGEST = 20, 16
ROOT = b""


def sequences_of(turns: DataFrame) -> DataFrame:
    """(conv_id, ids) of each conversation of (conv_id, turn, role, text)."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    length = F.unhex(F.lpad(F.hex(F.length(text)), 2 * (UNIT - DIGEST), "0"))
    keyed = turns.select("conv_id", F.struct(F.col("turn"), F.concat(digest, length).alias("id")).alias("t"))
    listed = keyed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # Hex digits of all turns side by side; sort_array puts null turns first.
    return listed.select("conv_id", F.unhex(F.array_join(F.transform("ts", lambda t: F.hex(t["id"])), "")).alias("ids"))


def rebuilt(convs: DataFrame, step: int = 100, most: int = 6) -> DataFrame:
    """Each conversation's first h turns replaced by those of the conversation at the ``step`` below it; h by a hash of its id."""
    own, base = F.col("conv_id"), F.col("conv_id") - F.col("conv_id") % step
    heads = convs.where(own % step == 0).select(own.alias("b"), F.substring("ids", 1, UNIT * (most - 1)).alias("head"))
    h = F.coalesce(F.crc32(own.cast("string")) % most, F.lit(0)).cast("int")
    head = F.coalesce(F.col("head"), F.lit(b""))
    first = F.expr("substring(head, 1, h * {0})".format(UNIT))
    rest = F.expr("substring(ids, h * {0} + 1)".format(UNIT))
    found = convs.withColumn("h", h).withColumn("base", base).join(heads, F.col("base") == F.col("b"), "left").withColumn("head", head)
    return found.select("conv_id", F.concat(first, rest).alias("ids"))


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with in common."""
    lo, hi = 0, min(len(a), len(b)) // UNIT
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * UNIT : mid * UNIT] == b[lo * UNIT : mid * UNIT]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _path(ids: str, turns: Column) -> Column:
    """Name of the path of the first ``turns`` turns."""
    return F.unhex(F.md5(F.substring(ids, F.lit(1), turns * UNIT)))


_SEQ = ["seq", "ids", "n", "first_id", "head", "up", "depth"]


def burst(seqs: DataFrame, most: int, scratch: Scratch) -> tuple[DataFrame | None, list[DataFrame], list[DataFrame]]:
    """Containers left (sequences with their container's path, the head above it, its depth; None if there are no rows at all),
    heads by round, and the sequences that end at the heads of each round.

    Heads: head (path), up (the head above), depth (its first turn's), last (its last turn's depth), turns (ids of those, first to last).
    """
    now, settled, heads, ended = seqs.withColumn("head", F.lit(ROOT)).withColumn("depth", F.lit(0)).withColumn("up", F.lit(None).cast("binary")), [], [], []
    while True:
        sizes = now.groupBy("head", "up", "depth").agg(F.count(F.lit(1)).alias("c"), F.min("ids").alias("low"), F.max("ids").alias("high"))
        # The root is a head whatever its size: it is the one node without a text.
        over = F.col("c") > most if heads else F.lit(True)

        def shared(batch):
            low, high, depth = (batch.column(c).to_pylist() for c in ("low", "high", "depth"))
            last = [common(a, b) for a, b in zip(low, high, strict=True)]
            return {"head": batch.column("head"), "up": batch.column("up"), "depth": depth, "last": last,
                    "turns": [a[max(d - 1, 0) * UNIT : k * UNIT] for a, d, k in zip(low, depth, last, strict=True)]}

        large = scratch.keep(map_arrow(sizes.where(over), shared, "head binary, up binary, depth int, last int, turns binary"))
        if large.isEmpty():
            return (union_all([*settled, now.select(*_SEQ)]) if heads else None), heads, ended
        heads.append(large)
        settled.append(now.join(large.select("head"), "head", "left_anti").select(*_SEQ))
        down = now.drop("up", "depth").join(large.select("head", "last"), "head")
        goes_on = F.octet_length("ids") > F.col("last") * UNIT
        ended.append(down.where(~goes_on).select("head", "seq", "n", "first_id"))
        now = scratch.keep(down.where(goes_on).select(
            "seq", "ids", "n", "first_id", F.col("head").alias("up"), (F.col("last") + 1).alias("depth"), _path("ids", F.col("last") + 1).alias("head")))


class _Node:
    __slots__ = ("first", "n", "children", "leaves", "saved", "seq", "own", "own_id", "below")

    def __init__(self):
        self.first, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.seq, self.own, self.own_id, self.below = None, 0, None, []


def least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


#: up: the head above, where the node is the first below it. own, own_id, seq: conversations that end at the node, one of them, their sequence.
_NODE = ("up binary, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "seq binary, own long, own_id long")
_NAMES = [f.split()[0] for f in _NODE.split(", ")]


def sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes (as ``_NODE``) of containers from their sorted sequences (head, up, depth, ids, seq, n, first_id).

    A node is handed out when its parent is closed, for only then the parent's name is known.
    """
    stack: list[_Node] = []
    head, up, top, before = None, None, 0, b""

    def close(depth: int) -> Iterator[tuple]:
        """Close open nodes deeper than ``depth``."""
        while stack and top + len(stack) - 1 > depth:
            at, node = top + len(stack) - 1, stack.pop()
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * int.from_bytes(before[at * UNIT - UNIT + DIGEST : at * UNIT], "big")
            for conv, below, *rest in node.below:
                yield None, conv, below, node.first, *rest
            row = node.first, at, node.n, node.children, leaves, saved, node.seq, node.own, node.own_id
            if stack:
                above = stack[-1]
                above.first, above.n, above.children = least(above.first, node.first), above.n + node.n, above.children + 1
                above.leaves, above.saved = above.leaves + leaves, above.saved + saved
                above.below.append(row)
            else:
                yield up, *row[:2], None, *row[2:]

    for here, over, depth, ids, seq, n, first in rows:
        if here != head:
            yield from close(-1)
            head, up, top, before = here, over, depth, b""
        else:
            yield from close(common(before, ids))
        while top + len(stack) - 1 < len(ids) // UNIT:
            stack.append(_Node())
        before, node = ids, stack[-1]
        node.first, node.n, node.seq, node.own, node.own_id = least(node.first, first), node.n + n, seq, n, first
    yield from close(-1)


def _swept(left: DataFrame) -> DataFrame:
    rows = left.select("head", "up", "depth", "ids", "seq", "n", "first_id").repartition("head").sortWithinPartitions("head", "ids")
    return map_rows(rows, sweep, _NODE)


def _head_nodes(sums: DataFrame) -> DataFrame:
    """The nodes of heads, first to last: only the last has several children, each above it one."""
    def run(batch):
        out = []
        for r in batch.to_pylist():
            lengths = [int.from_bytes(r["turns"][i + DIGEST : i + UNIT], "big") for i in range(0, len(r["turns"]), UNIT)]
            if not r["depth"]:
                lengths = [0, *lengths]
            saved, leaves = r["saved"] or 0, r["leaves"] if r["children"] else 1
            for at in range(r["last"], r["depth"] - 1, -1):
                saved += (r["n"] - 1) * lengths[at - r["depth"]]
                deepest = at == r["last"]
                up, above = (r["up"], None) if at == r["depth"] else (None, r["first_id"])
                ends = (r["seq"], r["own"], r["own_id"]) if deepest else (None, 0, None)
                out.append((up, r["first_id"], at, above, r["n"], r["children"] if deepest else 1, leaves, saved, *ends))
        return dict(zip(_NAMES, zip(*out, strict=True), strict=True)) if out else None

    return map_arrow(sums, run, _NODE)


def _ends(members: DataFrame, scratch: Scratch, piece: int) -> DataFrame:
    """(seq, ends): the hash of the ids of (seq, conv_id), in order."""
    def join(rows):
        at, held = None, []
        for seq, conv in rows:
            if held and (seq != at or len(held) == piece):
                yield at, held[0], ",".join("" if x is None else str(x) for x in held)
                held = []
            at = seq
            held.append(conv)
        if held:
            yield at, held[0], ",".join("" if x is None else str(x) for x in held)

    def feed(rows):
        at, state = None, None
        for seq, _, ids in rows:
            if seq == at:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                yield at, state.hexdigest()
            at, state = seq, hashlib.sha256(ids.encode())
        if state is not None:
            yield at, state.hexdigest()

    order = [F.asc("seq"), F.asc_nulls_last("conv_id")]
    ordered = scratch.keep(members).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = map_rows(ordered.select("seq", "conv_id"), join, "seq binary, lowest long, ids string")
    fed = pieces.repartition("seq").sortWithinPartitions(F.asc("seq"), F.asc_nulls_last("lowest"))
    return map_rows(fed, feed, "seq binary, ends string")


_SUMS = ["head", "up", "depth", "last", "turns", "first_id", "n", "children", "leaves", "saved", "seq", "own", "own_id"]


def _summed(heads: DataFrame, tops: DataFrame, ended: DataFrame) -> DataFrame:
    """Heads of one round with what lies below them: ``tops`` (up, conv_id, n_convs, n_leaves, saved_tokens, children) and the sequence that ends there."""
    below = tops.groupBy(F.col("up").alias("head")).agg(
        F.min("conv_id").alias("least"), F.sum("n_convs").alias("n_below"), F.sum("children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    here = ended.select("head", "seq", F.col("n").alias("own"), F.col("first_id").alias("own_id"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return heads.join(below, "head", "left").join(here, "head", "left").select(
        "head", "up", "depth", "last", "turns", F.least("least", "own_id").alias("first_id"), (zero("n_below") + zero("own")).alias("n"),
        *(zero(c).alias(c) for c in ("children", "leaves", "saved")), "seq", zero("own").alias("own"), "own_id")


_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(convs: DataFrame, most: int = 4_096, piece: int = 50_000) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv_id, ids); see the module's text. ``most``: sequences of a container."""
    scratch = Scratch(convs.sparkSession)
    members = scratch.keep(convs.select("conv_id", "ids", F.unhex(F.md5("ids")).alias("seq")))
    seqs = scratch.keep(members.groupBy("seq", "ids").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_id")))
    left, heads, ended = burst(seqs, most, scratch)
    if left is None:
        return convs.sparkSession.createDataFrame([], _RESULT)
    nodes = [scratch.keep(_swept(left))]
    tops = ["up", "conv_id", "n_convs", "n_leaves", "saved_tokens", "children"]
    of_containers = scratch.keep(nodes[0].where("up IS NOT NULL").groupBy("up").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.count(F.lit(1)).alias("children")))
    sums, deeper = [], None
    for level, ends in zip(reversed(heads), reversed(ended), strict=True):
        below = of_containers.select(*tops)
        if deeper is not None:
            below = below.unionByName(deeper.where("up IS NOT NULL").withColumn("children", F.lit(1).cast("long")).select(*tops))
        sums.append(scratch.keep(_summed(level, below, ends)))
        deeper = scratch.keep(_head_nodes(sums[-1].select(*_SUMS)))
        nodes.append(deeper)
    every = union_all(nodes)
    names = scratch.keep(union_all(sums).where("children > 0").select(F.col("head").alias("up"), "children", F.col("first_id").alias("parent")))
    under = attach(every.where("up IS NOT NULL").drop("parent_conv_id"), names, "up", "children").withColumnRenamed("parent", "parent_conv_id")
    every = every.where("up IS NULL").unionByName(under)
    repeated = scratch.keep(seqs.where("n > 1").select("seq", "n"))
    ends = _ends(attach(members.select("seq", "conv_id"), repeated, "seq", "n").select("seq", "conv_id"), scratch, piece)
    out = lambda rows, ends: rows.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                                         "n_leaves", "saved_tokens", ends.alias("ends_sha256"))
    single = F.when(F.col("own") == 1, F.coalesce(F.col("own_id").cast("string"), F.lit(""))).otherwise(F.lit(""))
    return out(every.where("own <= 1"), F.sha2(single, 256)).unionByName(out(every.where("own > 1").join(ends, "seq"), F.col("ends")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie(rebuilt(sequences_of(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


OP12_SQL = f"""
WITH {CRC_TABLE_SQL},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos FROM conversations),
h AS (SELECT conv_id AS c, conv_id - conv_id % 100 AS base, {crc_sql("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations), crc),
r AS (SELECT c, pos, role, text FROM h JOIN t ON t.conv_id = base AND pos <= h UNION ALL SELECT c, pos, role, text FROM h JOIN t ON t.conv_id = c AND pos > h),
k AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, length(text) AS len, md5(length(role) || ':' || role || text) AS key FROM r),
p AS (SELECT c, d, len, string_agg(key, '') OVER (PARTITION BY c ORDER BY d) AS path FROM k
  UNION ALL SELECT c, 0, 0, '' FROM h),
m AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS whole FROM p),
g AS (SELECT path, d, min(up) AS up, min(c) AS conv_id, count(*) AS n, min(len) AS len,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole), '')) AS ends FROM m GROUP BY path, d),
n AS (SELECT g.*, coalesce(children, 0) AS children FROM g LEFT JOIN (SELECT up AS path, count(*) AS children FROM g WHERE d > 0 GROUP BY up) USING (path)),
s AS (SELECT m.path, sum((children = 0)::BIGINT)::BIGINT AS leaves, sum((n - 1) * n.len)::BIGINT AS saved
  FROM n JOIN m ON m.c = n.conv_id AND m.d <= n.d GROUP BY m.path)
SELECT n.conv_id, n.d AS depth, a.conv_id AS parent_conv_id, n.n AS n_convs, n.children AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN g a ON n.d > 0 AND a.path = n.up
"""
