"""Vector codes: each vector is cut into equal parts, and a part becomes its nearest entry in a codebook of that place.

Codebooks start as the parts of the rows with the smallest ids and are improved by rounds of Ball k-means.  The parts
that an entry holds lie in a ball around it, and its radius bounds which entries can take one of them away: only those
nearer to the entry than twice the radius.  A part at distance d from its entry can only move to an entry nearer to
that entry than 2 d, so parts nearer than half the way to the nearest neighbour (the stable core) are not compared at
all, and the others, in rings by the number of neighbours within 2 d, with those neighbours alone.  All distances are
exact whole numbers, so the restriction never changes a result; a distance of exactly 2 d stays in, as ties go to the
lower index.  Balls are taken over the rows of a task's batch, which only makes them smaller.

Every round is one pass that assigns (from the codes of the round before) and one that sums; rows stay where they are,
and only sums per entry, bounded by the codebooks' size, reach the driver.  Each pass writes its codes to the shared
folder, and the codes of the round before are deleted.

Rows whose vector is null or has a null or non-finite component are left out; all others count, also when they
repeat or lack an id or label.  Rows that share an id start the codebooks in the order of their vectors; null ids come
last.  Vectors are filled up with zeros to the longest one, rounded up to whole parts.  Scaled components are held
within +-2^25.  With fewer rows than entries there are as many entries as rows; an empty table gives no rows.  Only id,
label and vector are read, so no other column can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.staging import discard, staged, widened
from pressmonth.llm.vectors import matrix, squared_distances, usable, whole

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE, LIMIT = 1024, 1 << 25
_STEP = 4096  # rows of one numpy pass


def first_codes(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point, and its squared distance, by comparing with all entries."""
    distances = squared_distances(points, entries)
    codes = distances.argmin(axis=1)  # the first of equal ones: the lower index
    return codes, distances[np.arange(len(points)), codes]


def ball_codes(points: np.ndarray, entries: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, starting from each point's entry of the round before."""
    own = ((points - entries[before]) ** 2).sum(axis=1)
    between = squared_distances(entries, entries)
    codes, found = before.copy(), own.copy()
    order = np.lexsort((own, before))
    edges = np.searchsorted(before[order], np.arange(len(entries) + 1))
    for entry in np.flatnonzero(np.diff(edges)):
        ball = order[edges[entry] : edges[entry + 1]]  # from the centre outwards
        radius = own[ball[-1]]
        neighbours = np.flatnonzero(between[entry] <= 4 * radius)
        neighbours = neighbours[np.argsort(between[entry][neighbours], kind="stable")]
        reach = np.searchsorted(between[entry][neighbours], 4 * own[ball], side="right")  # grows outwards
        start = int(np.searchsorted(reach, 1, side="right"))  # the stable core reaches its own entry alone
        while start < len(ball):
            count = min(len(neighbours), 2 * int(reach[start]))
            stop = int(np.searchsorted(reach, count, side="right"))
            ring, candidates = ball[start:stop], np.sort(neighbours[: int(reach[stop - 1])])
            distances = squared_distances(points[ring], entries[candidates])
            best = distances.argmin(axis=1)
            codes[ring], found[ring] = candidates[best], distances[np.arange(len(ring)), best]
            start = stop
    return codes, found


def assign(rows: DataFrame, books: np.ndarray, known: bool) -> DataFrame:
    """``rows`` with ``code`` (a byte for each part) and ``error``; ``known``: they have the code of a round before."""
    schema = widened(rows.select("id", "label", "vector").schema, code="binary", error="bigint")
    parts, _, size = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                piece = batch.slice(at, _STEP)
                points = matrix(piece.column("vector"), parts * size)
                codes, error = np.zeros((len(points), parts), np.uint8), np.zeros(len(points), np.int64)
                before = np.frombuffer(b"".join(piece.column("code").to_pylist()), np.uint8).reshape(-1, parts) if known else None
                for part in range(parts):
                    own = points[:, part * size : (part + 1) * size]
                    if known:
                        code, distance = ball_codes(own, books[part], before[:, part].astype(np.int64))
                    else:
                        code, distance = first_codes(own, books[part])
                    codes[:, part], error = code, error + distance
                yield pa.RecordBatch.from_arrays([
                    *(piece.column(c) for c in ("id", "label", "vector")),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                ], schema.names)

    return rows.mapInArrow(run, schema)


def summed(rows: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the parts that each entry holds; ``shape`` is that of the codebooks."""
    parts, entries, size = shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column("vector"), parts * size).reshape(-1, parts, size)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            totals = np.zeros((parts, entries, size + 1), np.int64)  # the count comes last
            for part in range(parts):
                np.add.at(totals[part, :, :size], codes[:, part], points[:, part])
                totals[part, :, size] = np.bincount(codes[:, part], minlength=entries)
            used = np.flatnonzero(totals[:, :, size].ravel())
            place = (used[:, None] * (size + 1) + np.arange(size + 1)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(totals.ravel()[place])], ["place", "total"])

    found = rows.select("vector", "code").mapInArrow(run, "place bigint, total bigint").groupBy("place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    totals = np.zeros(parts * entries * (size + 1), object)
    for row in found.collect():  # at most the size of the codebooks
        totals[row["place"]] = int(row["total"])
    totals = totals.reshape(parts, entries, size + 1)
    return totals[:, :, :size], totals[:, :, size]


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    key: str = "vec_id", label: str = "label", vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, vector, code, error) of every row that takes part, and the codebooks (parts x entries x size)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for each part")
    current = staged(rows.where(usable(F.col(vector))).select(
        F.col(key).alias("id"), F.col(label).alias("label"), whole(F.col(vector), SCALE, LIMIT).alias("vector")
    ))
    longest = current.agg(F.max(F.size("vector"))).first()[0] or 0
    size = -(-longest // parts)
    seeds = current.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    if not seeds:
        return assign(current, np.zeros((parts, 1, 1), np.int64), False), np.zeros((parts, 0, 0), np.int64)
    first = matrix(pa.array([r["vector"] for r in seeds], pa.list_(pa.int64())), parts * size)
    books = np.ascontiguousarray(first.reshape(len(first), parts, size).transpose(1, 0, 2))
    for turn in range(rounds):
        last, current = current, staged(assign(current, books, turn > 0))
        discard(last)
        sums, counts = summed(current, books.shape)
        held = counts > 0
        books = books.copy()
        books[held] = (sums[held] // counts[held][:, None]).astype(np.int64)
    return assign(current, books, rounds > 0), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` (id, label, error, ...) with ``label_error``, the errors of equal labels summed, nulls together.

    A label may hold any share of the rows: its sum is handed out in as many portions as there are partitions.
    """
    portions = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = coded.withColumn("portion", F.pmod(F.xxhash64("id", "code"), F.lit(portions)).cast("int"))
    sums = dealt.groupBy(F.col("label").alias("of"), F.col("portion").alias("for")).agg(F.sum("error").alias("error"))
    totals = sums.groupBy(F.col("of").alias("total_of")).agg(F.sum("error").alias("label_error"))
    handed = sums.select("of", "for").join(totals, F.col("of").eqNullSafe(F.col("total_of"))).select("of", "for", "label_error")
    return dealt.join(
        handed, F.col("label").eqNullSafe(F.col("of")) & (F.col("portion") == F.col("for"))
    ).drop("of", "for", "portion")
