"""Op 11: cheapest repair of the structure of conversations, by Viterbi over chunks that run side by side.

A conversation is right when its role initials read (s?(ua)+)?: nothing, or user and assistant in turn, perhaps after a system
row. Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (needed for blank and repeated rows), Insert an empty user or
assistant row 5; a truncated row that is not deleted costs 5 more. What is left to pay from a row on depends on one of four states
(nothing yet, after s, after u, after a), so a row acts on vectors of four backward costs, as a (min, +) matrix.

1. Rows are range-sorted by conversation, turn and digest; a conversation's rows in one sorted partition are cut into chunks of
   ``chunk`` rows. So a conversation of any length is spread over tasks, and a chunk is one byte a row.
2. Each chunk runs backwards from a speculative vector, that of a conversation's end. Vectors are kept less their minimum.
3. Fix-up passes: a chunk whose follower begins with another vector than it assumed runs again from that one, until its vectors
   equal those it had (they differed by a constant only, so all that lies before them stands). Passes go on until no
   chunk's assumption is wrong. Offsets add up to the costs. The last chunk is right from the start, so they end.
4. Forward, each chunk traces the least audit for each state it may be entered in; following the backward costs, the least
   letter whose cost is still the best gives the least string, since an edit's letter and the state fix the state after it.
   The pieces are stitched in one pass over chunks; the audit then meets the texts, streamed in order through the hash.

Defined results: a null role or text, and a null id or turn within the damage key, is one space. A null conv_id is a conversation of its own.
Rows are ordered by turn (null first), those of one turn by a digest of role and text; equal rows lie side by side. A role is judged by its
first character; any but s, u, a must be reroled or deleted. Conversations that lose all rows have zeros, an empty
audit and the hash of the empty string; with no row at all there is no conversation. An empty table gives no rows. Other columns are not
read. A conversation's audit travels in one row, one character an edit; its texts are only streamed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from asofkit.llm.common import CRC_TABLE_SQL, Scratch, crc_sql, map_rows, table

#: States, and what each reads next. NOTHING and AFTER_A may end.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
TO_U = {NOTHING: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}
#: State after a row of role s, u, a (codes 0, 1, 2) is kept, by state before.
KEPT = {0: {NOTHING: AFTER_S}, 1: TO_U, 2: {AFTER_U: AFTER_A}}
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
#: A row as a byte: role code 0-3, and these.
MUST_GO, TRUNCATED = 4, 8
#: Costs at the end of a conversation: user and assistant are put in where they are owed.
END = (0, 2 * INSERT, INSERT, 0)


def owed(state: int) -> int:
    """The state after an insertion, which is fixed: assistant after user, else user."""
    return AFTER_A if state == AFTER_U else AFTER_U


def edits(code: int) -> list[tuple[str, list[tuple[int, int]]]]:
    """For each state: (letter, cost, next state) of what may be done to a row, least letters first."""
    role, worse = code & 3, CUT_SHORT if code & TRUNCATED else 0
    out = []
    for state in range(4):
        can = [("D", DELETE, state)]
        if not code & MUST_GO:
            if role < 3 and state in KEPT[role]:
                can.append(("K", KEEP + worse, KEPT[role][state]))
            can.append(("R", REROLE + worse, owed(state)))
        out.append(can)
    return out


EDITS = [edits(code) for code in range(16)]


def with_insertions(v: list[int]) -> list[int]:
    """Costs where rows may be put in before going on; two in a row are the most that can pay."""
    u, a = min(v[AFTER_U], INSERT + v[AFTER_A]), min(v[AFTER_A], INSERT + v[AFTER_U])
    return [min(v[NOTHING], INSERT + u), min(v[AFTER_S], INSERT + u), u, a]


def back(code: int, v: tuple) -> tuple[tuple, int]:
    """The vector before a row from the vector after it, less its minimum, and that minimum."""
    w = with_insertions([min(cost + v[to] for _, cost, to in can) for can in EDITS[code]])
    low = min(w)
    return tuple(x - low for x in w), low


class Steps(dict):
    """``back``, looked up: there are 16 codes and few vectors."""

    def __missing__(self, key: tuple) -> tuple:
        got = self[key] = back(*key)
        return got


_STEPS = Steps()


def run_back(codes: bytes, after: tuple, old: list[tuple] | None = None, old_low: list[int] | None = None) -> tuple[list[tuple], list[int], int]:
    """Vectors before each row (and ``after`` last), the minimum taken off at each row, and the number of rows run.

    ``old``: vectors of an earlier run, from another ``after``. As soon as one is met again the rest is taken from it.
    """
    n = len(codes)
    vectors, low = [after] * (n + 1), [0] * n
    for i in range(n - 1, -1, -1):
        vectors[i], low[i] = _STEPS[codes[i], vectors[i + 1]]
        if old is not None and vectors[i] == old[i]:
            vectors[:i], low[:i] = old[:i], old_low[:i]
            return vectors, low, n - i
    return vectors, low, n


def trace(codes: bytes, vectors: list[tuple], state: int, last: bool) -> tuple[str, int]:
    """The least of the cheapest audits from ``state``, and the state in which it leaves the chunk."""
    audit = []
    for i, code in enumerate(codes):
        while True:
            # vectors[i] counts from some constant, vectors[i + 1] from another: only sums of one of them are compared.
            after = vectors[i + 1]
            put = owed(state)
            ways = [(letter, cost + after[to], to) for letter, cost, to in EDITS[code][state]]
            ways += [("I", INSERT * k + cost + after[to], put) for k, s in ((1, put), (2, owed(put))) for _, cost, to in EDITS[code][s]]
            best = min(cost for _, cost, _ in ways)
            letter, to = min((x, t) for x, cost, t in ways if cost == best)
            audit.append(letter)
            state = to
            if letter != "I":
                break
    while last and state not in (NOTHING, AFTER_A):
        audit.append("I")
        state = owed(state)
    return "".join(audit), state


# Chunks as they travel

def packed(vectors: list[tuple]) -> bytes:
    return bytes(x for v in vectors for x in v)


def unpacked(data: bytes) -> list[tuple]:
    return [tuple(data[i : i + 4]) for i in range(0, len(data), 4)]


_CHUNK = "conv_id long, part int, k int, codes binary, vectors binary, low binary, cost long, start binary, assumed binary"


def _solved(conv, part, k, codes: bytes, after: tuple, old: tuple | None = None) -> tuple:
    vectors, low, _ = run_back(codes, after, *(old or (None, None)))
    return conv, part, k, codes, packed(vectors), bytes(low), sum(low), bytes(vectors[0]), bytes(after)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that a hash of conversation and turn decides."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", word("conv_id"), word("turn"))) % 20
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role"))
    base = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("_kind")).where("_kind <> 0")
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))


def _judged(rows: DataFrame) -> DataFrame:
    """Rows without texts: conv_id, turn, digest, initial, blank, cut (truncated unless blank)."""
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    blank = bare == ""
    return rows.select("conv_id", "turn", _digest().alias("digest"), F.substring("role", 1, 1).alias("initial"), blank.alias("blank"),
                       (~blank & ~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))


def _with_repeats(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with first_turn: (is null, turn) of the first row of its conversation with its role and text, where there are two or more."""
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    often = scratch.keep(rows.groupBy("conv_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1"))
    same = often.select(F.col("conv_id").alias("c"), F.col("digest").alias("g"), "first")
    return (rows.join(same, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("g")), "left")
            .withColumn("later", F.coalesce(place > F.col("first"), F.lit(False))).drop("c", "g", "first"))


def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """Chunks of rows in order, solved from a speculative end, with what their rows alone tell: faults and joints."""
    def close(at, k, held):
        codes = bytes(("sua".find(i) if i and i in "sua" else 3) | (MUST_GO if b or d else 0) | (TRUNCATED if t else 0) for i, b, d, t in held)
        joints = sum((x[0], y[0]) not in RIGHT for x, y in zip(held, held[1:], strict=False))
        return *_solved(*at, k, codes, END), held[0][0], held[-1][0], *(sum(h[j] for h in held) for j in (1, 2, 3)), joints

    def run(rows):
        at, k, held, before = None, 0, [], None
        for conv, turn, digest, initial, blank, cut, later, part in rows:
            if held and (conv != at[0] or len(held) == chunk):
                yield close(at, k, held)
                k, held = (k + 1 if conv == at[0] else 0), []
            # Equal rows of one turn lie side by side, in one partition: all but the first repeat it.
            again = later or before == (conv, turn, digest)
            before, at = (conv, turn, digest), (conv, part)
            held.append((initial, blank, again and not blank, cut and not again))
        if held:
            yield close(at, k, held)

    order = ["conv_id", "turn", "digest"]
    placed = rows.select(*order, "initial", "blank", "cut", "later").repartitionByRange(*order).sortWithinPartitions(*order)
    return map_rows(placed.withColumn("part", F.spark_partition_id()), run,
                    _CHUNK + ", first string, last string, blank long, duplicate long, truncated long, illegal long")


#: Initials that may follow one another.
RIGHT = {("s", "u"), ("u", "a"), ("a", "u")}


def _fixed(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """Fix-up passes over the chunks of conversations that have several, until every chunk's assumption holds."""
    many = chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("chunks")).where("chunks > 1").select(F.col("conv_id").alias("c"))
    now = scratch.keep(chunks.join(many, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").select(*[f.split()[0] for f in _CHUNK.split(", ")]))

    def again(rows):
        for conv, part, k, codes, vectors, low, cost, start, assumed, needed in rows:
            if needed is None or needed == assumed:
                yield conv, part, k, codes, vectors, low, cost, start, assumed
            else:
                yield _solved(conv, part, k, codes, tuple(needed), (unpacked(vectors), list(low)))

    while True:
        following = W.partitionBy("conv_id").orderBy("part", "k")
        met = now.select("conv_id", "part", "k", "assumed", F.lead("start").over(following).alias("needed"))
        wrong = scratch.keep(met.where("needed <> assumed").select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("k").alias("q"), "needed"))
        if wrong.isEmpty():
            return now
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("k") == F.col("q"))
        now = scratch.keep(map_rows(now.join(wrong, same, "left").drop("c", "p", "q"), again, _CHUNK))


_TRACED = "conv_id long, part int, k int, cost long, start binary, exits binary, audits array<string>"


def _traced(solved: DataFrame) -> DataFrame:
    """For each chunk: exit state and least audit by entry state (only NOTHING for a conversation's first chunk)."""
    def run(rows):
        for conv, part, k, codes, vectors, cost, start, lead, last in rows:
            ways = [trace(codes, unpacked(vectors), s, last) if s == NOTHING or not lead else ("", 0) for s in range(4)]
            yield conv, part, k, cost, start, bytes(to for _, to in ways), [a for a, _ in ways]

    return map_rows(solved.select("conv_id", "part", "k", "codes", "vectors", "cost", "start", "lead", "last"), run, _TRACED)


def _stitched(traced: DataFrame, texts: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, repaired_sha256): chunks of a conversation first, in order, then its rows' texts."""
    schema = "conv_id long, cost long, audit string, repaired_sha256 string"
    left = traced.select("conv_id", F.lit(0).alias("kind"), "part", "k", "cost", "start", "exits", "audits", F.lit(None).cast("long").alias("turn"),
                         F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    right = texts.select("conv_id", F.lit(1).alias("kind"), F.lit(0).alias("part"), F.lit(0).alias("k"), F.lit(None).cast("long").alias("cost"), F.lit(None).cast("binary").alias("start"),
                         F.lit(None).cast("binary").alias("exits"), F.lit(None).cast("array<string>").alias("audits"), "turn", _digest().alias("digest"), "role", "text")

    def run(rows):
        one = None
        for conv, kind, _, _, cost, start, exits, audits, _, _, role, text in rows:
            if one is None or conv != one.conv:
                if one is not None:
                    yield one.close()
                one = _Repaired(conv, start[NOTHING])
            one.chunk(cost, exits, audits) if kind == 0 else one.row(role, text)
        if one is not None:
            yield one.close()

    order = ["conv_id", "kind", "part", "k", "turn", "digest"]
    return map_rows(left.unionByName(right).repartition("conv_id").sortWithinPartitions(*order), run, schema)


class _Repaired:
    """A conversation's audit put together from its chunks, then applied to its rows as they come."""

    def __init__(self, conv, first: int):
        self.conv, self.cost, self.state, self.pieces, self.at, self.audit = conv, first, NOTHING, [], 0, None
        self.hash, self.begun, self.last = hashlib.sha256(), False, "a"

    def chunk(self, cost: int, exits: bytes, audits: list[str]) -> None:
        self.cost += cost
        self.pieces.append(audits[self.state])
        self.state = exits[self.state]

    def _write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
        self.begun, self.last = True, role[:1]

    def _owed(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _insertions(self) -> None:
        if self.audit is None:
            self.audit = "".join(self.pieces)
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._write(self._owed(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._write(role if edit == "K" else self._owed(), text)

    def close(self) -> tuple:
        self._insertions()
        return self.conv, self.cost, self.audit, self.hash.hexdigest()


def repaired(rows: DataFrame, chunk: int = 4_096) -> DataFrame:
    """A row per conversation of ``rows`` (conv_id, turn, role, text): blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    scratch = Scratch(rows.sparkSession)
    narrow = scratch.keep(_judged(rows))
    chunks = scratch.keep(_chunks(scratch.keep(_with_repeats(narrow, scratch)), chunk))
    fixed = _fixed(chunks, scratch)
    names = [f.split()[0] for f in _CHUNK.split(", ")]
    of_many = fixed.select(F.col("conv_id").alias("c")).distinct()
    alone = chunks.join(of_many, F.col("conv_id").eqNullSafe(F.col("c")), "left_anti").select(*names)
    along = W.partitionBy("conv_id").orderBy("part", "k")
    ends = alone.withColumn("lead", F.lit(True)).withColumn("last", F.lit(True)).unionByName(
        fixed.withColumn("lead", F.lag("k").over(along).isNull()).withColumn("last", F.lead("k").over(along).isNull()))
    done = _stitched(_traced(ends), rows)
    # Where two chunks meet, two initials do.
    joint = F.struct(F.lag("last").over(along).alias("x"), F.col("first").alias("y"))
    wrong = F.when(joint["x"].isNotNull() & ~F.concat(joint["x"], joint["y"]).isin(*("".join(p) for p in RIGHT)), 1).otherwise(0)
    faults = chunks.withColumn("_joint", wrong).groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.sum(F.col("illegal") + F.col("_joint")).alias("illegal"))
    return (done.join(faults.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, after the damage: its faults, and its cheapest repair."""
    source = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(source)
    done = repaired(rows)
    span = rows.select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    every = source.select(F.col("conv_id").alias("id")).distinct()
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (every.join(done, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(span, F.col("id").eqNullSafe(F.col("c")), "left")
            .select(F.col("id").alias("conv_id"), *map(count, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))


#: The same by plain recursion over rows. Insertions are left out: to delete what they would complete, and at worst a system row
#: before it, costs 4 at most, so none is ever cheapest.
OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
w AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
v AS (SELECT conv_id, turn, role, text, {crc_sql("key")} % 20 AS k FROM w, crc),
x AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM v WHERE k <> 0),
o AS (SELECT conv_id, turn, role, text, left(role, 1) AS init, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i FROM x),
f AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS cut,
  lag(init) OVER (PARTITION BY conv_id ORDER BY i) || init NOT IN ('su', 'ua', 'au') AS joint, count(*) OVER (PARTITION BY conv_id) AS n FROM o),
z AS (SELECT *, NOT (blank OR again) AS may, CASE WHEN cut THEN 5 ELSE 0 END AS worse FROM f),
back AS (SELECT DISTINCT conv_id, n + 1 AS i, 0 AS e, 1000000 AS s, 1000000 AS u, 0 AS a FROM z
  UNION ALL SELECT z.conv_id, z.i,
    least(2 + e, CASE WHEN may AND init = 's' THEN worse + s END, CASE WHEN may AND init = 'u' THEN worse + u END, CASE WHEN may THEN 1 + worse + u END),
    least(2 + s, CASE WHEN may AND init = 'u' THEN worse + u END, CASE WHEN may THEN 1 + worse + u END),
    least(2 + u, CASE WHEN may AND init = 'a' THEN worse + a END, CASE WHEN may THEN 1 + worse + a END),
    least(2 + a, CASE WHEN may AND init = 'u' THEN worse + u END, CASE WHEN may THEN 1 + worse + u END)
  FROM back b JOIN z ON z.conv_id IS NOT DISTINCT FROM b.conv_id AND z.i = b.i - 1),
y AS (SELECT z.*, [b.e, b.s, b.u, b.a] AS here, [c.e, c.s, c.u, c.a] AS there
  FROM z JOIN back b ON z.conv_id IS NOT DISTINCT FROM b.conv_id AND z.i = b.i JOIN back c ON z.conv_id IS NOT DISTINCT FROM c.conv_id AND z.i + 1 = c.i),
fore AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 'e' AS state, '' AS edit, 'e' AS came FROM z
  UNION ALL SELECT y.conv_id, y.i,
    CASE edit_ WHEN 'D' THEN state WHEN 'K' THEN init ELSE CASE WHEN state = 'u' THEN 'a' ELSE 'u' END END, edit_, state
  FROM fore p JOIN y ON y.conv_id IS NOT DISTINCT FROM p.conv_id AND y.i = p.i + 1, LATERAL (SELECT
    CASE WHEN here[strpos('esua', state)] = 2 + there[strpos('esua', state)] THEN 'D'
    WHEN may AND (state || init) IN ('es', 'eu', 'su', 'au', 'ua') AND here[strpos('esua', state)] = worse + there[strpos('esua', init)] THEN 'K' ELSE 'R' END AS edit_)),
done AS (SELECT y.conv_id, string_agg(edit, '' ORDER BY y.i) AS audit,
  sha256(coalesce(string_agg(CASE edit WHEN 'K' THEN role ELSE CASE WHEN came = 'u' THEN 'assistant' ELSE 'user' END END || ':' || text, chr(10) ORDER BY y.i)
    FILTER (WHERE edit <> 'D'), '')) AS repaired_sha256
  FROM y JOIN fore p ON y.conv_id IS NOT DISTINCT FROM p.conv_id AND y.i = p.i GROUP BY y.conv_id),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::BIGINT)::BIGINT AS blank, sum((again AND NOT blank)::BIGINT)::BIGINT AS duplicate,
  sum((cut AND NOT blank AND NOT again)::BIGINT)::BIGINT AS truncated, coalesce(sum(joint::BIGINT), 0)::BIGINT AS illegal FROM z GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.e, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM q.conv_id AND b.i = 1
"""
