"""N-lag, tolerance-bounded as-of join.

Each left row gets the latest N observations of its key at or before its own time, newest first, no older than
the tolerance. Left rows and observations are put into one frame, shuffled once by key, sorted by time, and each
left row looks back over the non-NULL observations before it. No pair of rows is ever formed, so the work is
that of one sort, whatever the number of rows per key.

Hot keys. A key is only one group as long as it is small. Larger ones are cut into time segments of about equal
row count, so a key, a day or an instant that holds a third of all rows spreads over many tasks:

* Cut points come from a sample of (key, time), as in Spark's own range sort. They decide only which task does
  the work, never the result. Their number is that of rows / ``segment_rows``, about 24 bytes each, and ``MOST_PIECES`` at most,
  so the driver may hold them, and a task sort their sample of ``_MOST_POINTS`` at most. Beyond that (1.3e11 rows in segments
  of the default length) more rows make longer segments, not more of them.
* A row finds its segment in an index of the cuts, level by level: a node of a key holds ``FAN`` cuts at most, so no row
  meets a key's whole list, whatever its length. The roots of keys with over a thousandth of all cuts (a thousand at most) are
  broadcast; every other level is broadcast below the session's threshold and else equi-joined on (key, node), where a
  node stands for ``FAN`` segments, so a hot key does not gather in one task.
* A segment starts with the last N observations before it ("carry"). These are found among the last N of each
  earlier segment, N x pieces rows at most, without moving the rest: a block of ``BLOCK`` segments at a time, each led by the
  last N before it, which are found among the last N of each earlier block.
* An instant that spans several cut points cannot be cut by time. Of its observations only the N that rank
  highest can ever be seen, so the others stop at the map side; its left rows are dealt over several salts, each
  of which gets the (at most N) observations they all share.
* Left rows without key or time match nothing and are dealt over salts likewise.

Salts are built from the row's hash and its input partition: identical copies in different input partitions part,
and a task that is run again deals the same, as long as it reads the same input partition again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT_ROWS = 1_000_000
#: Cuts that pass through the driver at most, whatever the length of segments asked for.
MOST_PIECES = 1 << 17
_SAMPLE_PER_PIECE = 100
#: Sampled rows at most: still 16 for each of ``MOST_PIECES``.
_MOST_POINTS = 1 << 21
#: Segments whose carry is found in one group.
BLOCK = 512
_MICROS_PER_HOUR = 3_600_000_000

# order of rows at one instant: a segment's start, observations, left rows
_START, _OBSERVATION, _PROBE = 0, 1, 2


#: Cuts in a node of the index.
FAN = 64
#: Keys with more than one in so many of all cuts have their root broadcast.
_HEAVY = 1_000


@dataclass(frozen=True)
class Splits:
    """Cut points of hot keys: a frame (key columns, _cuts array, _mult array<int>), their index, and their limits.

    index: per level, parts of (frame (keys, _node, _first array, at the leaves _times array<int>), bytes, heavy roots or not).
    """

    frame: DataFrame
    pieces: int
    most_cuts: int
    has_instants: bool
    index: tuple[tuple[tuple[DataFrame, int, bool], ...], ...] = ()


def _keyed(df: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    """Add key columns and ``_t``: a zoneless time as it is, one with a zone as microseconds, since cut points
    pass through the driver, where such times would be read in its own zone."""
    zoneless = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    return df.withColumns({
        **{f"_k{i}": F.col(c) for i, c in enumerate(by)},
        "_t": F.col(ts) if zoneless else F.unix_micros(ts),
    })


def _earlier(df: DataFrame, c: Column, hours: int) -> Column:
    """``c``, a value like ``_t`` of ``df``, some hours before."""
    if isinstance(df.schema["_t"].dataType, T.TimestampNTZType):
        return c - F.expr(f"INTERVAL {int(hours)} HOURS")
    return c - int(hours) * _MICROS_PER_HOUR


def _complete(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def find_splits(points: DataFrame, keys: Sequence[str], segment_rows: int, max_pieces: int | None,
                total: int | None = None) -> Splits | None:
    """Cut points for the keys that hold more than their share of ``points`` (columns: keys and ``_t``).

    None when everything is small enough for whole keys. Reads the key and time columns only. ``max_pieces`` is the
    caller's own limit of pieces below ``MOST_PIECES``, which makes segments longer; ``total`` saves counting rows that are counted
    already.
    """
    spark = points.sparkSession
    total = points.count() if total is None else total
    pieces = min(ceil(total / segment_rows), MOST_PIECES)
    if max_pieces is not None:
        pieces = min(pieces, max_pieces)
    if pieces <= 1:
        return None
    fraction = min(1.0, min(_SAMPLE_PER_PIECE * pieces, _MOST_POINTS) / total)
    step = max(1, round(total * fraction / pieces))
    by_time = Window.partitionBy(*keys).orderBy("_t")
    cuts = (
        points.where(_complete([*keys, "_t"]))
        .sample(fraction=fraction, seed=7)
        .withColumn("_n", F.row_number().over(by_time))
        .where(F.col("_n") % step == 0)
        .groupBy(*keys, "_t").agg(F.count(F.lit(1)).cast("int").alias("_m"))
        .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_t", "_m"))).alias("_c"))
        .select(*keys, F.col("_c._t").alias("_cuts"), F.col("_c._m").alias("_mult"))
    )
    rows = cuts.collect()  # every cut stands for `step` sampled rows: at most about `pieces` values in all
    return Splits(
        frame=spark.createDataFrame(rows, cuts.schema),
        pieces=pieces,
        most_cuts=max((len(r["_cuts"]) for r in rows), default=0),
        has_instants=any(m > 1 for r in rows for m in r["_mult"]),
        index=_index(rows, cuts, len(keys)),
    )


_BYTES_PER_CUT = 24
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def _index(rows: Sequence[Row], cuts: DataFrame, n_keys: int) -> tuple[tuple[tuple[DataFrame, int, bool], ...], ...]:
    """Levels of the index from the root down. Node p of a level stands for ``wide`` cuts from the p-th ``wide`` on, and holds the
    first cut of each of its children; a leaf holds its cuts themselves and the one that follows, and how often each is cut."""
    spark, total = cuts.sparkSession, sum(len(r["_cuts"]) for r in rows)
    schema = T.StructType([*cuts.schema.fields[:n_keys], T.StructField("_node", T.IntegerType()),
                           T.StructField("_first", cuts.schema["_cuts"].dataType), T.StructField("_times", cuts.schema["_mult"].dataType)])
    depth, most = 1, max((len(r["_cuts"]) for r in rows), default=0)
    while FAN**depth < most:
        depth += 1
    levels = []
    for level in range(depth):
        wide, step = FAN ** (depth - level), FAN ** (depth - level - 1)
        kinds: dict[bool, list] = {True: [], False: []}
        for r in rows:
            c, m = r["_cuts"], r["_mult"]
            for at in range(0, len(c), wide):
                first = c[at : at + wide + 1] if step == 1 else c[at : at + wide : step]
                times = m[at : at + wide] if step == 1 else []
                kinds[level == 0 and len(c) * _HEAVY > total].append((*r[:n_keys], at // wide, first, times))
        levels.append(tuple(
            (spark.createDataFrame(nodes, schema), _BYTES_PER_CUT * sum(len(n[-2]) + 1 for n in nodes), heavy)
            for heavy, nodes in kinds.items() if nodes
        ))
    return tuple(levels)


def _broadcastable(df: DataFrame, size: int) -> bool:
    """Whether ``size`` bytes stay below the size up to which the session broadcasts."""
    digits, unit = re.fullmatch(r"(-?\d+)([a-z]*)", df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()).groups()
    return size <= int(digits) * _UNITS[unit]


def _segmented(df: DataFrame, keys: Sequence[str], splits: Splits) -> DataFrame:
    """Add ``_seg`` (cut points at or before ``_t``), ``_end`` (the next one) and ``_deal`` (salts of a hot
    instant, else NULL)."""
    if splits.most_cuts == 0:
        return df.withColumns({
            "_seg": F.lit(0), "_end": F.lit(None).cast(df.schema["_t"].dataType), "_deal": F.lit(None).cast("int")
        })
    # binary search in a node, FAN + 1 values at most; a probe past the end yields NULL and is not taken
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((FAN + 1).bit_length()))])
    rank = F.aggregate(
        steps, F.lit(0), lambda low, s: F.when(F.get("_first", low + s - 1) <= F.col("_t"), low + s).otherwise(low))
    out = df.withColumn("_node", F.when(_complete([*keys, "_t"]), 0))
    for depth, parts in enumerate(splits.index):
        found = []
        for i, (nodes, size, heavy) in enumerate(parts):
            small = heavy or _broadcastable(df, size)
            named = nodes.withColumnsRenamed({"_first": f"_first{i}", "_times": f"_times{i}"})
            out = out.join(F.broadcast(named) if small else named, [*keys, "_node"], "left")
            found.append(i)
        out = out.withColumns({
            "_first": F.coalesce(*[F.col(f"_first{i}") for i in found]),
            "_times": F.coalesce(*[F.col(f"_times{i}") for i in found]),
        }).drop(*[f"_{x}{i}" for x in ("first", "times") for i in found]).withColumn("_rank", F.when(F.col("_first").isNotNull(), rank))
        if depth < len(splits.index) - 1:
            child = F.col("_node") * FAN + F.greatest(F.col("_rank") - 1, F.lit(0))
            out = out.withColumn("_node", child).drop("_first", "_times", "_rank")
    last, mult = F.get("_first", F.col("_rank") - 1), F.get("_times", F.col("_rank") - 1)
    return (
        out.withColumns({
            "_seg": F.coalesce(F.col("_node") * FAN + F.col("_rank"), F.lit(0)),
            "_end": F.get("_first", F.col("_rank")),
            "_deal": F.when((last == F.col("_t")) & (mult > 1), mult),
        })
        .drop("_first", "_times", "_rank", "_node")
    )


def _look_back(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """For each row that is no observation: ``_h1.._hN``, the observations before it, newest first."""
    group = [*keys, "_seg", "_salt"]
    order = ["_t", "_side", "_o"]
    if n == 1:
        running = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        seen = {"_h1": F.last("_o", ignorenulls=True).over(running)}
    else:
        over = f"OVER (PARTITION BY {', '.join(group)} ORDER BY {', '.join(order)})"
        seen = {f"_h{k}": F.expr(f"lag(_o, {k}) IGNORE NULLS {over}") for k in range(1, n + 1)}
    return rows.withColumns(seen).where(F.col("_side") != _OBSERVATION).drop("_o")


def _seen(n: int) -> Column:
    return F.array_compact(F.array(*[F.col(f"_h{k}") for k in range(1, n + 1)]))


def _top(df: DataFrame, group: Sequence[str], n: int) -> DataFrame:
    """The last N observations of each group; Spark ranks before the shuffle too."""
    newest = Window.partitionBy(*group).orderBy(F.col("_o").desc())
    return df.withColumn("_rk", F.row_number().over(newest)).where(F.col("_rk") <= n).drop("_rk")


def _split_observations(obs: DataFrame, keys: Sequence[str], n: int, hours: int | None,
                        splits: Splits) -> DataFrame:
    """Observations of all segments, each led by its carry, plus the shared ones of each salt of hot instants."""
    placed = _segmented(obs, keys, splits)
    plain = placed.where(F.col("_deal").isNull())
    near_end = F.col("_end").isNotNull()
    if hours is not None:
        near_end &= F.col("_t") >= _earlier(obs, F.col("_end"), hours)
    columns = [*keys, "_seg", "_t", "_o"]
    tails = _top(plain.where(near_end), [*keys, "_seg"], n).select(*columns)
    body = plain.select(*columns)
    if splits.has_instants:
        shared = _top(placed.where(F.col("_deal").isNotNull()), [*keys, "_seg"], n).select(*columns)
        tails, body = tails.unionByName(shared), body.unionByName(shared)

    starts = (
        splits.frame
        .select(*keys, F.posexplode(F.arrays_zip("_cuts", "_mult")).alias("_pos", "_c"))
        .select(*keys, (F.col("_pos") + 1).alias("_into"), F.col("_c._cuts").alias("_t"),
                F.col("_c._mult").alias("_mult"))
    )
    kinds = F.array(F.lit(_START), F.lit(_PROBE)) if splits.has_instants else F.array(F.lit(_START))
    probes = starts.withColumn("_side", F.explode(kinds)).where(
        (F.col("_side") == _START) | (F.col("_mult") > 1)
    )

    def newest(few: DataFrame, at: DataFrame) -> DataFrame:
        rows = few.withColumn("_side", F.lit(_OBSERVATION)).unionByName(at, allowMissingColumns=True)
        return _look_back(rows.withColumn("_salt", F.lit(0)), keys, n).withColumn("_o", F.explode(_seen(n)))

    if splits.most_cuts < BLOCK:
        tails, probes = tails.withColumn("_seg", F.lit(0)), probes.withColumn("_seg", F.lit(0))
    else:  # a block goes by its first segment
        tails = tails.withColumn("_seg", F.col("_seg") - F.col("_seg") % BLOCK)
        probes = probes.withColumn("_seg", F.col("_into") - F.col("_into") % BLOCK)
        firsts = probes.where((F.col("_seg") == F.col("_into")) & (F.col("_side") == _START))
        before = newest(_top(tails, [*keys, "_seg"], n).withColumn("_seg", F.lit(0)), firsts.withColumn("_seg", F.lit(0)))
        tails = tails.unionByName(before.select(*keys, F.col("_into").alias("_seg"), F.col("_o.t").alias("_t"), "_o"))
    carried = newest(tails, probes)
    # a start feeds the segment itself (salt 0), an instant its salts 1..mult
    salts = F.when(F.col("_side") == _START, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.col("_mult")))
    carried = carried.select(
        *keys, F.col("_into").alias("_seg"), F.col("_o.t").alias("_t"), "_o", F.explode(salts).alias("_salt")
    )
    return body.withColumn("_salt", F.lit(0)).unionByName(carried)


def asof_lags(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str] | str,
    left_ts: str,
    right_ts: str,
    right_by: Sequence[str] | str | None = None,
    tolerance_hours: int | None = 12,
    lags: int = 7,
    payload: Sequence[str] | None = None,
    tie_break: Sequence[str] = (),
    out: str = "matches",
    ts_name: str = "w_ts",
    legacy_unmatched: bool = False,
    segment_rows: int = SEGMENT_ROWS,
    max_pieces: int | None = None,
    measure: DataFrame | None = None,
    total: int | None = None,
) -> DataFrame:
    """Attach to each left row the last ``lags`` right rows at or before ``left_ts`` with the same key.

    ``lags`` > 0 gives ``out`` as array<struct<ts_name, payload...>>, newest first; ``lags`` = 0 a single struct.
    Both bounds, ``left_ts`` and ``left_ts - tolerance_hours``, count as inside. Among observations of one time
    the highest ``tie_break`` values come first, then the highest payload, so the result is fully determined.
    Unmatched left rows get an empty array or a NULL struct, with ``legacy_unmatched`` an all-NULL struct instead.

    Starts one count over both inputs, and one sample of them when they exceed ``segment_rows``. Where ``left``
    is costly to make, ``measure`` may name a table with about the same keys and times to count in its place; where
    the number of rows of both is known, ``total`` saves the count.
    """
    if lags < 0:
        raise ValueError(f"lags must not be negative: {lags}")
    by = [by] if isinstance(by, str) else list(by)
    right_by = by if right_by is None else [right_by] if isinstance(right_by, str) else list(right_by)
    if len(by) != len(right_by):
        raise ValueError(f"keys differ in number: {by} and {right_by}")
    payload = [c for c in right.columns if c not in (*right_by, right_ts)] if payload is None else list(payload)
    n, keys = max(lags, 1), [f"_k{i}" for i in range(len(by))]

    probes = _keyed(left, by, left_ts)
    obs = _keyed(right.where(_complete([*right_by, right_ts])), right_by, right_ts)
    measured = probes if measure is None else _keyed(measure, by, left_ts)
    splits = find_splits(
        measured.select(*keys, "_t").unionByName(obs.select(*keys, "_t")), keys, segment_rows, max_pieces, total
    )

    obs = obs.select(*keys, "_t", F.struct(
        F.col("_t").alias("t"),
        F.struct(*[F.col(c) for c in tie_break], F.lit(0).alias("_")).alias("tie"),
        F.struct(F.col(right_ts).alias(ts_name), *[F.col(c) for c in payload]).alias("r"),
    ).alias("_o"))
    record = obs.schema["_o"].dataType["r"].dataType

    if splits is None:
        probes = probes.withColumns({"_seg": F.lit(0), "_salt": F.lit(0)})
        obs = obs.withColumns({"_seg": F.lit(0), "_salt": F.lit(0)})
    else:
        plain_columns = [f.name for f in left.schema if isinstance(f.dataType, T.AtomicType)]
        deal = F.xxhash64(*plain_columns, F.spark_partition_id())
        salt = (
            F.when(~_complete([*keys, "_t"]), F.pmod(deal, F.lit(splits.pieces)).cast("int") + 1)
            .when(F.col("_deal").isNotNull(), F.pmod(deal, F.col("_deal")).cast("int") + 1)
            .otherwise(0)
        )
        probes = _segmented(probes, keys, splits).withColumn("_salt", salt)
        if splits.most_cuts == 0:
            obs = obs.withColumns({"_seg": F.lit(0), "_salt": F.lit(0)})
        else:
            obs = _split_observations(obs, keys, n, tolerance_hours, splits)

    rows = (
        probes.select(*keys, "_seg", "_salt", "_t", F.lit(_PROBE).alias("_side"),
                      F.struct(*[F.col(c) for c in left.columns]).alias("_l"))
        .unionByName(obs.withColumn("_side", F.lit(_OBSERVATION)), allowMissingColumns=True)
    )
    found = _look_back(rows, keys, n)
    oldest = None if tolerance_hours is None else _earlier(rows, F.col("_t"), tolerance_hours)

    def inside(k: int) -> Column:
        h = F.col(f"_h{k}")
        return h.isNotNull() if oldest is None else F.coalesce(h["t"] >= oldest, F.lit(False))

    nulls = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in record.fields])
    if lags == 0:
        result = F.when(inside(1), F.col("_h1.r"))
        if legacy_unmatched:
            result = F.coalesce(result, nulls)
    else:
        # newest first: the ones inside the tolerance come before those outside
        count = reduce(lambda a, b: a + b, [inside(k).cast("int") for k in range(1, n + 1)])
        result = F.slice(F.array(*[F.col(f"_h{k}.r") for k in range(1, n + 1)]), 1, count)
        if legacy_unmatched:
            result = F.when(count == 0, F.array(nulls)).otherwise(result)
    return found.select(*[F.col("_l")[c].alias(c) for c in left.columns], result.alias(out))
