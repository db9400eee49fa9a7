"""Hard negatives by slot-decomposed selection.

Every anchor has positives, its nearest rows of the same label, and every positive asks for the first negatives (rows
of another label) whose score lies in its window, from a lower to an upper share of the positive's score.  The upper
limits of an anchor's windows cut the scores into disjoint slots.  A task scores a block of rows against a block of
anchors and keeps the first ``negatives`` rows of each slot (the combiner); blocks are merged by the same rule.  The
slots at and below a window's upper limit, in descending order, are one sorted list: the first rows of that suffix,
cut at the lower limit, answer the window, however the windows overlap.

The stated anchors meet all rows in blocks of bounded size: a cell holds about ``BLOCK_ROWS`` rows and ``BLOCK_ANCHORS``
anchors, dealt by hashes of their ids, so no row is broadcast, none reaches the driver, and no pairs leave a task but
those kept.

Scores are exact inner products of floor(scale * x).  Rows with a null id, a null label, a null vector or a null or
non-finite component take no part.  Rows that share an id count as one, the least by label and vector.  Missing
components of a shorter vector are zeros, and scaled components are held within +-2^21 so that scores fit.  Ties go to
the smaller id.  A window of a negative positive score is empty, and fewer candidates give fewer rows.  An empty table
gives no rows.  Only id, label and vector are read, so no other column can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmonth.llm.staging import staged
from pressmonth.llm.vectors import matrix, products, usable, whole

SCALE, LIMIT = 256, 1 << 21
BLOCK_ROWS, BLOCK_ANCHORS = 8192, 32768
_STEP = 256  # anchors scored at once
_NONE = np.iinfo(np.int64).min


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: by score descending, then id."""
    order = np.lexsort((ids, -score, group))
    sorted_ = group[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_, sorted_) < k]


def _scored(points: pa.Table, anchors: pa.Table):
    """Per step of anchors: its bounds, the scores (rows x anchors) and whether row and anchor share the label or the id."""
    vectors, asked = matrix(points.column("vector")), matrix(anchors.column("vector"))
    ids, labels = points.column("id").to_numpy(), points.column("label").to_numpy()
    anchor_ids, anchor_labels = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
    for start in range(0, len(asked), _STEP):
        stop = min(start + _STEP, len(asked))
        same = labels[:, None] == anchor_labels[None, start:stop]
        itself = ids[:, None] == anchor_ids[None, start:stop]
        yield slice(start, stop), products(vectors, asked[start:stop]), same, itself


def _met(points: DataFrame, anchors: DataFrame, parts: int, groups: int, function, schema: str) -> DataFrame:
    """``function`` on every block of rows with every block of anchors."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = points.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("group", every(groups))
    asked = anchors.withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")).withColumn("part", every(parts))
    return rows.groupBy("part", "group").cogroup(asked.groupBy("part", "group")).applyInArrow(function, schema)


def _ranked(rows: DataFrame, *group: str) -> Column:
    return F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "id"))


def nearest_same(points: DataFrame, anchors: DataFrame, parts: int, groups: int, k: int) -> DataFrame:
    """(anchor, id, score, place): the first ``k`` other rows of each anchor's label."""

    def keep(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, anchor_ids = rows.column("id").to_numpy(), asked.column("id").to_numpy()
        out = [[], [], []]
        for step, scores, same, itself in _scored(rows, asked):
            scores = np.where(same & ~itself, scores, _NONE)
            floor = np.partition(scores, len(ids) - k, axis=0)[len(ids) - k] if len(ids) > k else _NONE
            row, column = np.nonzero((scores >= floor) & (scores > _NONE))
            score = scores[row, column]
            best = _first(column, score, ids[row], k)
            for kept, values in zip(out, (anchor_ids[step][column[best]], ids[row[best]], score[best])):
                kept.append(values)
        return _table(("anchor", "id", "score"), out)

    near = _met(points, anchors, parts, groups, keep, "anchor bigint, id bigint, score bigint")
    return near.withColumn("place", _ranked(near, "anchor")).where(F.col("place") <= k)


def _table(names: tuple[str, ...], columns: list[list[np.ndarray]]) -> pa.Table:
    return pa.table({n: pa.array(np.concatenate(c) if c else [], pa.int64()) for n, c in zip(names, columns)})


def slot_bests(points: DataFrame, asked: DataFrame, parts: int, groups: int, k: int) -> DataFrame:
    """(anchor, slot, id, score): the first ``k`` rows of another label in each slot of each anchor.

    ``asked`` has the anchors with ``uppers`` (distinct upper limits, descending) and ``lowest`` (least lower limit).
    Slot s lies at or below uppers[s] and above uppers[s + 1].
    """

    def keep(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, anchor_ids = rows.column("id").to_numpy(), anchors.column("id").to_numpy()
        lists = anchors.column("uppers").to_pylist()
        uppers = np.full((len(lists), max(map(len, lists), default=1)), _NONE)
        for i, found in enumerate(lists):
            uppers[i, : len(found)] = found
        lowest = anchors.column("lowest").to_numpy()
        out = [[], [], [], []]
        for step, scores, same, itself in _scored(rows, anchors):
            row, column = np.nonzero(~same & ~itself & (scores >= lowest[step]) & (scores <= uppers[step, 0]))
            score = scores[row, column]
            slot = (uppers[step][column] >= score[:, None]).sum(axis=1) - 1
            best = _first(column * uppers.shape[1] + slot, score, ids[row], k)
            for kept, values in zip(out, (anchor_ids[step][column[best]], slot[best], ids[row[best]], score[best])):
                kept.append(values)
        return _table(("anchor", "slot", "id", "score"), out)

    found = _met(points, asked, parts, groups, keep, "anchor bigint, slot bigint, id bigint, score bigint")
    return found.withColumn("__place", _ranked(found, "anchor", "slot")).where(F.col("__place") <= k).drop("__place")


def _floor_percent(score: Column, percent: int) -> Column:
    product = score * percent
    return ((product - F.pmod(product, F.lit(100))) / 100).cast("bigint")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    key: str = "vec_id", label: str = "label", vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Windows are low * positive score <= 100 * negative score <= high * positive score.  ``is_anchor`` is a condition
    on the id, there called ``id``.
    """
    known = rows.where(usable(F.col(vector)) & F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        whole(F.col(vector), SCALE, LIMIT).alias("vector"),
    )
    points = staged(known.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("one")).select("id", "one.*"))
    anchors = points.where(is_anchor)
    counts = points.agg(F.count("*"), F.count_if(is_anchor)).first()
    parts, groups = max(1, -(-counts[0] // BLOCK_ROWS)), max(1, -(-counts[1] // BLOCK_ANCHORS))

    near = staged(
        nearest_same(points, anchors, parts, groups, positives)
        .withColumn("upper", _floor_percent(F.col("score"), high))
        .withColumn("lower", -_floor_percent(-F.col("score"), low))
        .where("lower <= upper")
    )
    windows = near.groupBy("anchor").agg(
        F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.min("lower").alias("lowest")
    )
    asked = staged(anchors.join(windows, F.col("id") == F.col("anchor")).drop("anchor"))
    bests = slot_bests(points, asked, parts, groups, negatives)
    # an anchor's slots one after the other: at most positives * negatives rows in descending order
    merged = bests.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("order"), "id", "score"))).alias("slots")
    )
    slot = F.array_position("uppers", F.col("upper")) - 1
    suffix = F.slice(F.filter("slots", lambda s: s["slot"] >= F.col("from")), 1, negatives)
    answered = (
        near.join(windows.select("anchor", "uppers"), "anchor").join(merged, "anchor").withColumn("from", slot)
        .withColumn("found", F.filter(suffix, lambda s: s["score"] >= F.col("lower")))
    )
    return answered.select(
        F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.posexplode("found").alias("place", "negative"),
    ).select(
        "anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("negative.id").alias("negative_id"),
        "positive_score", F.col("negative.score").alias("negative_score"),
    )
