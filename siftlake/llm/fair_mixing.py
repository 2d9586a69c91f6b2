"""Mixing sources by weighted fair queueing, in DataFrame functions only.

Each source's documents stand in a shuffled order, up to ``most`` times over. A copy of a document finishes at the virtual
time *tokens of its source up to and with it, divided by the source's weight*. All copies are put in order of their finish,
and the mix takes them from the start until the budget is used up. A source that runs out leaves its share to the others
by their weights, as the targets do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.columns import put_aside
from siftlake.workspace import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHT_CYCLE = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"
# Rows that are put in order together; the number of such runs follows the number of rows.
ROWS_PER_RUN = 10_000
# Ranges that the finishes are dealt into, besides the square root of the number of copies.
LEAST_RANGES = 1024
# The columns of the result beside those of the documents.
NEW = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = WEIGHT_CYCLE) -> DataFrame:
    """``source, place, weight``: the distinct sources by code point, null last, and the weights over and over.

    One row per source is put in order in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    distinct = sources.select("source").distinct().withColumn("place", F.row_number().over(order))
    weight = F.element_at(F.array(*(F.lit(w) for w in cycle)), F.pmod(F.col("place") - 1, F.lit(len(cycle))) + 1)
    return distinct.select("source", "place", weight.alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, place, weight, source_size, target`` from ``source, size`` rows.

    Sources that reach ``most`` times their size at a low level are served first; the level at which the rest of the budget
    is shared by weight is that of the first source that does not. One row per source is put in order in one task.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = weights.withColumnRenamed("source", "named")
    joined = per_source.join(known, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    cap = F.col("source_size") * float(most)
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    levels = joined.withColumn("level", left / F.sum("weight").over(after))
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= cap, F.col("place"))).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    first = F.first(F.when(open_level.isNotNull(), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levels.select(
        "source", "place", "weight", "source_size",
        F.least(cap, F.coalesce(first * F.col("weight"), cap)).alias("target"),
    )


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with its size, its place in the shuffle (``draw``) and what tells rows of one id apart (``tie``)."""
    draw = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.withColumns(
        {"size": word_count(F.col("text")), "draw": F.substring(draw, 1, 16), "tie": F.xxhash64("text")}
    )


def _in_order(measured: DataFrame, planned: DataFrame, offsets: DataFrame, runs: int) -> DataFrame:
    """``measured`` with the tokens of its source up to and with each row, and the columns of its source."""
    placed = measured.withColumn("run", _run(runs))
    within = Window.partitionBy("source", "run").orderBy("draw", "doc_id", "size", "tie")
    placed = placed.withColumn("so_far", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    known = offsets.withColumnsRenamed({"source": "named", "run": "named_run"})
    placed = placed.join(known, F.col("source").eqNullSafe(F.col("named")) & (F.col("run") == F.col("named_run")))
    of_source = planned.withColumnRenamed("source", "planned")
    placed = placed.join(of_source, F.col("source").eqNullSafe(F.col("planned")))
    return placed.withColumn("so_far", F.col("so_far") + F.col("before")).drop(
        "named", "named_run", "planned", "before", "run"
    )


def _run(runs: int) -> Column:
    """The run of a row: equal ranges of the shuffle."""
    return F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / float(2**32) * runs).cast("int")


def _place(copy: Column) -> Column:
    """Where a copy of a document stands in the order of all copies."""
    finish = (copy * F.col("source_size") + F.col("so_far")) / F.col("weight")
    return F.struct(
        finish.alias("finish"), F.col("place"), copy.alias("copy"), F.col("draw"), F.col("doc_id"), F.col("size"),
        F.col("tie"),
    )


def mix(
    docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``docs`` (``doc_id, text, source`` and more) with ``size`` (words), ``source_size``, ``target`` (words its source
    should give), ``copies`` and ``taken`` (words the mix takes of it).

    Empty and null texts have no words and take part with nothing. A null source is a source like others. A null id is
    shuffled as an empty one. Rows that repeat an id count one by one. Columns of ``docs`` that bear the name of a new one are replaced.
    Without any word nothing is taken; an empty table gives no rows. The same rows give the same mix.

    The order within a source is summed in runs of the shuffle and over the runs, the order of all copies in ranges of
    the finish and over the ranges, so that neither a large source nor the whole goes through one task.
    """
    mixed, own = _mixed(docs.drop(*NEW), weights, share, most)
    return mixed.select(*own.values(), *NEW)


def _mixed(
    docs: DataFrame, weights: DataFrame | None, share: float, most: int
) -> tuple[DataFrame, dict[str, Column]]:
    """The columns of ``docs``, put aside, with the new ones, and the expressions that name the former again."""
    docs, own = put_aside(docs, ("doc_id", "text", "source"))
    scratch = Scratch(docs.sparkSession, "mix")
    slim = scratch.settle(_measured(docs.select("doc_id", "text", "source")).drop("text"), "sizes")
    if weights is None:
        weights = cycled_weights(slim)
    planned = scratch.settle(targets(slim, weights, share, most), "targets")
    rows, total = slim.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    runs = -(-rows // ROWS_PER_RUN) or 1
    per_run = slim.groupBy("source", _run(runs).alias("run")).agg(F.sum("size").alias("of_run"))
    earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_run.select(
        "source", "run", F.coalesce(F.sum("of_run").over(earlier), F.lit(0)).alias("before")
    )
    offsets = scratch.settle(offsets, "offsets")
    copies = F.sequence(F.lit(0), F.lit(most - 1))
    ordered = _in_order(slim, planned, offsets, runs).withColumn("copy", F.explode(copies))
    queue = scratch.settle(ordered.select(_place(F.col("copy")).alias("at")), "queue")
    # As many ranges as a range has copies, so that neither many ranges nor a long one has to be put in order.
    left = _first_left(queue, total * share, math.isqrt(rows * most) + LEAST_RANGES)
    ordered = _in_order(_measured(docs), planned, offsets, runs)
    taken = F.lit(most if total else 0)
    if left is not None:
        bound = F.struct(*(F.lit(left[f.name]).cast(f.dataType).alias(f.name) for f in queue.schema["at"].dataType))
        taken = F.lit(0)
        for copy in range(most):
            taken += (_place(F.lit(copy)) < bound).cast("int")
    mixed = ordered.withColumn("copies", taken)
    mixed = mixed.withColumn("taken", F.col("size") * F.col("copies"))
    return mixed.select(*docs.columns, *NEW), own


def _first_left(queue: DataFrame, budget: float, ranges: int):
    """Where the queue is cut: the first copy that is not within the budget any more; None if all are.

    Sizes are summed by equal ranges of the finish, then the range that the budget ends in by ranges of its own, and so on until
    it holds no more than ``ranges`` copies. So the copies of a large source that finish close together among those of small
    ones are not put in order by one task. Copies of one finish are not told apart that way, but each source has at most
    ``most`` of these: copies without words, which may share one, can't exceed a budget and are not looked at.
    """
    within, before = queue.where("at.size > 0"), 0
    finish = F.col("at.finish")
    extent = (F.count(F.lit(1)).alias("held"), F.min(finish).alias("low"), F.max(finish).alias("high"))
    found = within.agg(*extent).first()
    while found.held > ranges and found.low < found.high:
        at = F.floor((finish - F.lit(found.low)) / F.lit(found.high - found.low) * ranges)
        dealt = within.groupBy(F.least(at, F.lit(ranges - 1)).alias("range")).agg(F.sum("at.size").alias("of_range"), *extent)
        running = dealt.withColumn("upto", F.sum("of_range").over(Window.orderBy("range")) + F.lit(before))
        found = running.where(F.col("upto") > budget).orderBy("range").first()
        if found is None:
            return None
        before = found.upto - found.of_range
        within = within.where(finish.between(found.low, found.high))
    exact = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    upto = within.withColumn("upto", F.sum("at.size").over(exact) + F.lit(before))
    return upto.where(F.col("upto") > budget).agg(F.min("at")).first()[0]


def repeated(
    docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all columns of ``docs``, whatever their names."""
    mixed, own = _mixed(docs, weights, share, most)
    taken = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*own.values())


ORACLE_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           substr(md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 16) AS draw
    FROM documents),
named AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM (SELECT DISTINCT source FROM documents)),
weighted AS (
    SELECT n.source, n.place, CASE (n.place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
           s.source_size
    FROM named n JOIN (SELECT source, sum(size) AS source_size FROM sized GROUP BY source) s
        ON n.source IS NOT DISTINCT FROM s.source),
levels AS (
    SELECT *, source_size * 2.0 AS cap,
           (sum(source_size) OVER () * 1.5 - coalesce(sum(source_size * 2.0) OVER (ORDER BY source_size / weight, place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
           / sum(weight) OVER (ORDER BY source_size / weight, place
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted),
planned AS (
    SELECT l.*, least(cap, weight * (SELECT arg_min(level, source_size / weight) FROM levels
        WHERE level * weight <= cap)) AS target FROM levels l),
ordered AS (
    SELECT s.doc_id, s.size, s.draw, p.place, p.weight, p.source_size, p.target,
           sum(s.size) OVER (PARTITION BY p.place ORDER BY s.draw, s.doc_id ROWS UNBOUNDED PRECEDING) AS so_far
    FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
queue AS (
    SELECT *, CAST(copy * source_size + so_far AS DOUBLE) / weight AS finish FROM ordered, (VALUES (0), (1)) AS c(copy)),
running AS (
    SELECT *, sum(size) OVER (ORDER BY finish, place, copy, draw, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM queue)
SELECT doc_id, CAST(any_value(size) AS BIGINT) AS size, CAST(any_value(source_size) AS BIGINT) AS source_size,
       CAST(any_value(target) AS DOUBLE) AS target,
       CAST(count(*) FILTER (WHERE upto <= (SELECT sum(size) FROM sized) * 1.5) AS INTEGER) AS copies,
       CAST(coalesce(sum(size) FILTER (WHERE upto <= (SELECT sum(size) FROM sized) * 1.5), 0) AS BIGINT) AS taken
FROM running GROUP BY doc_id
"""
