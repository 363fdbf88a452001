"""Op 8: mixing sources to target weights by a curriculum that changes over the training.

Each source has a weight schedule over training time 0..1 (linear between knots). Its integral, scaled to the source's
target, is the source's cumulative demand; a document's place in its source's stream (its words so far, in the order of
a hash) is inverted through that demand to a training position, and documents are range-sorted by position.

Targets: sources in order of code points (null last) weigh 1, 2, 3, repeating, and share all words; a target stops at
``most`` times its source's size, and the excess is shared anew by weight. In the order of cap to weight the sources
that stop are the first ones, so the sharing is one running sum over sources, not a loop.

The stream of a source is cut into buckets of about ``bucket_rows`` rows by the hash. A bucket's running sum is a
window over one bucket, and what lies before a bucket is a running sum over the bucket table, so a source with a third
of all rows is spread over the cluster. Windows over all sources hold one row per source.

A stream is passed over again until the target is met; the last document is taken in part, so that the sum of a
source's taken words is its target rounded down. The order hash is the MD5 of doc_id and text: runs agree.

Defined results: null or blank text has size 0 and is never taken. A null source is a source of its own. Rows that
repeat are separate; equal ones share a place evenly (rounded down). Only where all words are 0 are targets 0. An empty
table gives no rows. Other columns are carried by ``occurrences`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from asofkit.llm.common import WORD, Scratch, table

#: Weight of a source along the training, by its weight class: (time, weight) knots from 0 to 1.
SCHEDULES = {1: ((0.0, 2.0), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 3: ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0))}


def sizes(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def order_key(id: str, text: str) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))


def source_targets(rows: DataFrame, most: int = 3) -> DataFrame:
    """(_source, _rows, _source_size, _class, _target) from rows (_source, _size)."""
    by = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_source_size"))
    ranked = by.withColumn("_class", F.row_number().over(W.orderBy(F.asc_nulls_last("_source"))) - 1).withColumn("_class", (F.col("_class") % 3 + 1).cast("int"))
    filled = W.orderBy(F.col("_source_size") / F.col("_class"), F.asc_nulls_last("_source"))
    before, whole = filled.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    cap = F.col("_source_size") * most
    left = F.sum("_source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights = F.sum("_class").over(whole) - F.coalesce(F.sum("_class").over(before), F.lit(0))
    fair = ranked.withColumn("_level", left / weights).withColumn("_n", F.row_number().over(filled))
    # The first that its fair share leaves below its cap sets the level for all that follow.
    first = fair.withColumn("_open", F.min(F.when(F.col("_level") * F.col("_class") < cap, F.col("_n"))).over(whole))
    level = F.max(F.when(F.col("_n") == F.col("_open"), F.col("_level"))).over(whole)
    stops = F.col("_open").isNull() | (F.col("_n") < F.col("_open"))
    return first.withColumn("_target", F.when(stops, cap.cast("double")).otherwise(level * F.col("_class"))).select(
        "_source", "_rows", "_source_size", "_class", "_target")


def position(share: Column, weight_class: Column, schedules: dict = SCHEDULES) -> Column:
    """The time at which a source's demand reaches ``share`` (0..1) of its target: its integrated weights inverted.

    Between two knots the integral is a quadratic in time, so the inverse is its root.
    """
    out = F.lit(None).cast("double")
    for c, knots in schedules.items():
        pieces, total = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
            pieces.append((t0, w0, (w1 - w0) / (t1 - t0), total, total + (w0 + w1) / 2 * (t1 - t0)))
            total = pieces[-1][4]
        need, here = share * total, None
        for t0, w0, slope, low, _ in pieces:
            d = need - low
            root = d / w0 if slope == 0 else (F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * d, F.lit(0.0))) - w0) / slope
            root = t0 + root
            here = root if here is None else F.when(need >= low, root).otherwise(here)
        out = F.when(weight_class == c, here).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def source_name(source: str) -> Column:
    """A null source gets a name that no other has: names are prefixed."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def streams(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", most: int = 3,
            bucket_rows: int = 20_000, carry: list[str] | None = None) -> DataFrame:
    """A row per row: row (a struct of the columns ``carry``, all if None), _name (of its source), _key (of its order), _size, _source_size,
    _class, _target, _before (words before it in its source's stream), _ties (rows equal to it) and _taken."""
    scratch = Scratch(docs.sparkSession)
    names = docs.columns if carry is None else carry
    rows = docs.select((F.struct(*names) if names else F.lit(0)).alias("row"), F.col(source).alias("_source"),
                       sizes(text).alias("_size"), order_key(id, text).alias("_key"))
    if carry is not None:
        rows = scratch.keep(rows)
    targets = scratch.keep(source_targets(rows.select("_source", "_size"), most))
    name = source_name("_source").alias("_name")
    plan = targets.select(name, "_source_size", "_class", "_target", F.ceil(F.col("_rows") / bucket_rows).alias("_buckets"))
    # Buckets by the leading hex digits of the key, in its order.
    lead = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    placed = rows.withColumn("_name", name).drop("_source").join(plan, "_name").withColumn("_bucket", F.floor(lead * F.col("_buckets") / (1 << 32)))
    sums = placed.groupBy("_name", "_bucket").agg(F.sum("_size").alias("_in"))
    before = W.partitionBy("_name").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = scratch.keep(sums.select(F.col("_name"), "_bucket", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_start")))
    inside = W.partitionBy("_name", "_bucket").orderBy("_key")
    ties = W.partitionBy("_name", "_bucket", "_key")
    # Within range frames rows of one key are one place; all that follow begin after all of them.
    running = placed.withColumn("_ties", F.count(F.lit(1)).over(ties)).withColumn("_upto", F.sum("_size").over(inside.rangeBetween(W.unboundedPreceding, 0)))
    full = running.join(starts, ["_name", "_bucket"])
    size, group = F.col("_size"), F.col("_size") * F.col("_ties")
    start = (F.col("_start") + F.col("_upto") - group).alias("_before")
    target = F.floor("_target").cast("long")
    rounds = F.when(F.col("_source_size") > 0, F.floor(target / F.col("_source_size")).cast("long")).otherwise(0)
    rest = target - rounds * F.col("_source_size")
    part = F.floor(F.greatest(F.lit(0), F.least(rest - start, group)) / F.col("_ties")).cast("long")
    return full.select("row", "_name", "_key", "_size", "_source_size", "_class", "_target", start, "_ties",
                       (rounds * size + part).alias("_taken"), rounds.alias("_rounds"))


def occurrences(mixed: DataFrame, schedules: dict = SCHEDULES, cut: bool = True) -> DataFrame:
    """A row for each time that a document is taken: the columns of ``mixed``, _words (taken now) and _position.

    cut=False takes documents whole: the last pass's part counts if it is half of the document or more.
    """
    size = F.col("_size")
    part = F.col("_taken") - F.col("_rounds") * size
    last = F.when(part > 0 if cut else 2 * part >= size, 1).otherwise(0)
    times = F.when(size > 0, F.col("_rounds") + last).otherwise(F.lit(0)).cast("int")
    each = mixed.withColumn("_pass", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
    words = F.when(F.col("_pass") < F.col("_rounds"), size).otherwise(part if cut else size)
    share = (F.col("_pass") * F.col("_source_size") + F.col("_before") + words / 2) / F.col("_target")
    return each.withColumn("_words", words).withColumn("_position", position(F.least(share, F.lit(1.0)), F.col("_class"), schedules))


def mixed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", schedules: dict = SCHEDULES) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken whole, in training order.

    Streams, targets and positions are those of ids, sizes and keys; the rows themselves are joined to their positions, then sorted.
    Equal rows have one key and one share, so a position belongs to each of them.
    """
    placed = streams(docs, id, text, source, carry=[]).dropDuplicates(["_name", "_key"])
    at = Scratch(docs.sparkSession).keep(occurrences(placed, schedules, cut=False).select("_name", "_key", "_position"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), source_name(source).alias("_name"), order_key(id, text).alias("_key"))
    return in_training_order(rows.join(at, ["_name", "_key"]), f"row.`{id}`").select("row.*")


def in_training_order(rows: DataFrame, id: str = "doc_id", position: str = "_position") -> DataFrame:
    """Range-sorted by position: file after file is the training order."""
    return rows.repartitionByRange(position, id).sortWithinPartitions(position, id)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents: the words that the mix takes of it, and the position at which it is first taken."""
    mixed = streams(table(spark, sf_dir, "documents"), carry=["doc_id", "source"])
    first = F.when(F.col("_taken") > 0, position((F.col("_before") + F.least("_size", "_taken") / 2) / F.col("_target"), F.col("_class")))
    rows = mixed.select("row.doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                        F.col("_taken").alias("taken"), first.alias("_position"))
    return in_training_order(rows).withColumnRenamed("_position", "first_position")
