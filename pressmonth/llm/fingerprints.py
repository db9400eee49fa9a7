"""Bottom-k sketches of word-shingle hashes as DataFrame expressions.

A sketch is the ascending array of the k least distinct 64-bit hashes of a text's five-word shingles (a shorter
text: one shingle of all its words).  The sketch of a union is the k least of the parts' sketches, so parts can be
sketched anywhere and merged.  Fewer than k hashes are the whole set, and then every estimate is exact.

Null and empty texts have the empty sketch; two empty sketches resemble each other fully, an empty and another one
not at all.  Equal texts have equal sketches.  Everything here stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 128
SHINGLE_WORDS = 5
_SPAN = float(2**64)


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Distinct hashes of the shingles of a text, ascending."""
    found = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(all_words: Column) -> Column:
        long = F.transform(
            F.sequence(F.lit(0), F.size(all_words) - words), lambda i: F.xxhash64(*[F.get(all_words, i + k) for k in range(words)])
        )
        short = F.array(F.xxhash64(F.concat(F.array(F.size(all_words).cast("string")), all_words)))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(all_words) >= words, long).when(F.size(all_words) > 0, short).otherwise(none)

    # a one-element array binds the words once for all uses in the lambda
    return F.sort_array(F.array_distinct(F.flatten(F.transform(F.array(found), of))))


def sketch(text: Column, size: int = SIZE) -> Column:
    return F.slice(shingle_hashes(text), 1, size)


def merge(left: Column, right: Column, size: int = SIZE) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, size)


def merge_parts(parts: DataFrame, keys: list[str], column: str = "sketch", size: int = SIZE) -> DataFrame:
    """One sketch for each key of ``parts``; rows are cut to ``size`` before a key's hashes meet."""
    hashes = parts.select(*keys, F.explode(column).alias("__hash")).distinct()
    least = hashes.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("__hash"))).where(F.col("__n") <= size)
    merged = least.groupBy(*keys).agg(F.sort_array(F.collect_list("__hash")).alias(column))
    return parts.select(*keys).distinct().join(merged, keys, "left").withColumn(
        column, F.coalesce(column, F.array().cast("array<bigint>"))
    )


def distinct_count(sketched: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles: exact below ``size`` hashes, else (k - 1) / the k-th least as a fraction."""
    kth = (F.element_at(sketched, -1).cast("double") + F.lit(_SPAN / 2)) / F.lit(_SPAN)
    return F.when(F.size(sketched) < size, F.size(sketched).cast("double")).otherwise((size - 1) / kth)


def resemblance(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that lies in both."""
    union = merge(left, right, size)
    both = F.size(F.array_intersect(F.array_intersect(union, left), right))
    empty = (F.size(left) == 0) & (F.size(right) == 0)
    return F.when(empty, F.lit(1.0)).when(left == right, F.lit(1.0)).otherwise(both / F.size(union))


def containment(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated share of the left text's shingles that the right one has (1 for an empty left text)."""
    shared = resemblance(left, right, size) * distinct_count(merge(left, right, size), size)
    return F.when(F.size(left) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(left, size)))


def digest(sketched: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_following(docs: DataFrame, columns: list[str], key: str = "doc_id", rows_per_range: int = 4000) -> DataFrame:
    """Each row with ``next_<column>`` of the row after it in descending ``key`` order; after the last comes the first.

    Keys are dealt into ranges at approximate quantiles, so the order is never in one task: a window takes the next
    row inside a range, and the first rows of the ranges, one each, follow the last ones.  Rows with equal keys are
    ordered by their columns; null keys come last.
    """
    spark = docs.sparkSession
    count = docs.count()
    ranges = max(1, min(2048, -(-count // rows_per_range)))
    bounds = docs.agg(
        F.percentile_approx(key, [i / ranges for i in range(1, ranges)] or [0.5], 10_000)
    ).first()[0] if count else None
    bounds = sorted(set(bounds or []))
    position = F.lit(0) if not bounds else F.when(F.col(key).isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(F.lit(bounds), lambda b: b < F.col(key)))
    )
    dealt = docs.withColumn("__range", position)
    order = [F.col(key).desc_nulls_last(), *[F.col(c) for c in columns]]
    inside = Window.partitionBy("__range").orderBy(*order)
    rows = dealt.withColumn("__next", F.lead(F.struct(*columns)).over(inside)).withColumn(
        "__edge", F.lead(F.lit(True)).over(inside).isNull()
    )
    # the first row of each range follows the last row of the range above it (of the lowest: the first of all)
    firsts = dealt.withColumn("__n", F.row_number().over(Window.partitionBy("__range").orderBy(*order))).where("__n = 1")
    heads = firsts.select("__range", F.struct(*columns).alias("__head"))
    present = sorted(r[0] for r in heads.select("__range").collect())  # at most 2049 numbers
    above = {low: high for low, high in zip(present, present[1:])}
    if present:
        above[present[-1]] = present[0]
    follows = spark.createDataFrame(list(above.items()) or [(0, 0)], "__range int, __of int")
    edges = heads.join(F.broadcast(follows), "__range").select(F.col("__of").alias("__range"), F.lit(True).alias("__edge"), "__head")
    joined = rows.join(edges, ["__range", "__edge"], "left")
    following = F.coalesce("__next", "__head")
    return joined.select(*docs.columns, *[following[c].alias(f"next_{c}") for c in columns])
