"""Near-duplicate classes by fast similarity sketching, banding and exact verification.

A document's set is its distinct five-word shingles (A-Z lower-cased; fewer words: the whole sequence).  Its sketch
has one coordinate for each bin: in round i < t every element is thrown into a random bin with value (i, hash), in
round t + j every element goes to bin j, and a bin keeps its least value; so 2t rounds fill every bin, a few suffice
for larger sets, and the share of equal coordinates concentrates around the Jaccard similarity.  Bands of the sketch
give candidates.  With 5 coordinates a band and 48 bands, a pair at similarity 0.75 is missed with probability
(1 - 0.75^5)^48 < 3e-6; pairs above it less.

Texts with the same words in the same order form a class first (only ids and digests are grouped), and its least id
stands for it.  Within a bucket of equal band keys no list of all pairs is made.  First every member is compared with
the bucket's least id, and links merge components.  Where the other members still belong to different components, the
bucket is cut into blocks of bounded size and the blocks are compared inside tasks, which give links only.  So every
candidate pair is either compared on full sets or known to be connected already, however large a bucket is.

Null texts and texts without words are linked with nothing.  Rows that share an id are one node.  A null id gets a
null component and is kept.  Empty tables give no rows.  Only the id is carried, so no other column can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.arrays import lowered, mix, shingles, slices, text_bytes, words
from pressmonth.llm.staging import staged, widened

BANDS, BAND_ROWS = 48, 5
SHINGLE_WORDS = 5
BLOCK_ROWS, BLOCK_SHINGLES = 512, 400_000  # of a block of a bucket whose members must be compared among themselves
PERCENT = 75  # links have 100 * intersection >= PERCENT * union
_OPEN = np.uint64(2**64 - 1)


def similarity_sketches(row: np.ndarray, values: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """Sketches (rows x bins) of the sets given as (row, element) pairs in row order; an empty set's stays open."""
    sketch = np.full(rows * bins, _OPEN)
    for turn in range(2 * bins):
        thrown = mix(values, 101 + turn)
        place = (thrown >> np.uint64(40)) % np.uint64(bins) if turn < bins else np.uint64(turn - bins)
        value = np.uint64(turn << 54) | (mix(thrown, 5) >> np.uint64(10))
        np.minimum.at(sketch, row * bins + place.astype(np.int64), value)
        open_rows = (sketch.reshape(rows, bins) == _OPEN).any(axis=1)
        keep = open_rows[row]
        if not keep.all():
            row, values = row[keep], values[keep]
        if not len(row):
            break
    return sketch.reshape(rows, bins)


def band_keys(sketch: np.ndarray, bands: int, width: int) -> np.ndarray:
    factors = mix(np.arange(bands * width, dtype=np.uint64), 77) | np.uint64(1)
    return mix((mix(sketch[:, : bands * width], 9) * factors).reshape(-1, bands, width).sum(axis=2, dtype=np.uint64), 13)


def sketched(docs: DataFrame, key: str, text: str, bands: int, width: int) -> DataFrame:
    """``key``, ``n_shingles``, ``class`` (digest of the lower-cased word sequence) and ``bands`` of every row."""
    schema = widened(docs.select(key).schema, **{"n_shingles": "bigint", "class": "binary", "bands": "array<bigint>"})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                data, offsets = text_bytes(piece.column(text))
                data = lowered(data)
                row, values = shingles(words(data, offsets), SHINGLE_WORDS)
                counts = np.bincount(row, minlength=piece.num_rows)
                keys = band_keys(similarity_sketches(row, values, piece.num_rows, bands * width), bands, width)
                keys = keys[counts > 0].view(np.int64).ravel()
                ends = np.append(0, np.cumsum(np.where(counts > 0, bands, 0)))
                raw = data.tobytes()
                classes = [
                    hashlib.blake2b(b" ".join(raw[a:b].split()), digest_size=16).digest()
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(key), pa.array(counts, pa.int64()), pa.array(classes, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys))],
                    schema.names,
                )

    return docs.select(key, text).mapInArrow(run, schema)


def word_sets(texts: list[str | None]) -> Iterator[set[bytes]]:
    for value in texts:
        found = (value or "").encode().lower().split()
        if len(found) < SHINGLE_WORDS:
            yield {b" ".join(found)} if found else set()
        else:
            yield {b" ".join(found[i : i + SHINGLE_WORDS]) for i in range(len(found) - SHINGLE_WORDS + 1)}


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar enough."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    ).select("a", "b", "text_a", "text_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                sets = zip(word_sets(part.column("text_a").to_pylist()), word_sets(part.column("text_b").to_pylist()))
                linked = []
                for left, right in sets:
                    shared = len(left & right)
                    linked.append(bool(shared) and 100 * shared >= percent * (len(left) + len(right) - shared))
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(run, pairs.schema)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id reachable over ``links`` (a, b), for every id that has a link.

    Large-star and small-star steps in turn; each keeps the reachable sets and shortens the paths, until all links
    point at the least id.
    """
    spark = links.sparkSession
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("id"))
    )


def full_sets(texts: DataFrame, bands: int, width: int) -> DataFrame:
    """(id, n_shingles, bands, hashes): sketch and 64-bit shingle hashes of each row of ``texts`` (id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                data, offsets = text_bytes(piece.column("text"))
                row, values = shingles(words(lowered(data), offsets), SHINGLE_WORDS)
                keys = band_keys(similarity_sketches(row, values, piece.num_rows, bands * width), bands, width)
                ends = np.searchsorted(row, np.arange(piece.num_rows + 1))
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.arange(piece.num_rows + 1) * bands, pa.int32()), pa.array(keys.view(np.int64).ravel())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(np.diff(ends), pa.int64()), *lists], ["id", "n_shingles", "bands", "hashes"]
                )

    schema = widened(texts.select("id").schema, n_shingles="bigint", bands="array<bigint>", hashes="array<bigint>")
    return texts.mapInArrow(run, schema)


def blockwise(entries: DataFrame, texts: DataFrame, percent: int, bands: int, width: int) -> DataFrame:
    """Links (a, b) between members of a bucket whose components differ; ``entries`` has (key, id, component).

    A bucket is cut into blocks of bounded size and every two blocks meet in one task, so only links leave it.  A
    pair that shares several buckets is compared in that of its first common band.
    """
    sets = staged(full_sets(texts.join(entries.select("id").distinct(), "id", "left_semi"), bands, width))
    # an id on rows with different texts is a member with those of its rows that lie in the bucket
    place = F.array_position(F.transform("bands", lambda b, i: F.xxhash64(i, b)), F.col("key")).cast("int") - 1
    inside = entries.join(sets, "id").withColumn("band", place).where("band >= 0")
    sizes = inside.groupBy("key").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    dealt = (
        entries.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "id", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .join(sets, "id").withColumn("band", place).where("band >= 0")
    )
    id_type = entries.schema["id"].dataType.simpleString()

    def compare(place: tuple, members: pa.Table) -> pa.Table:
        ids = members.column("id").to_pylist()
        component = members.column("component").to_numpy()
        block = members.column("block").to_numpy()
        bands = np.stack(members.column("bands").to_numpy())
        sets_ = [set(h.tolist()) for h in members.column("hashes").to_numpy()]
        size = np.array([len(h) for h in sets_])
        band = members.column("band")[0].as_py()
        i, j = place[1].as_py(), place[2].as_py()
        found_a, found_b = [], []
        for x in range(len(ids)):
            if i != j and block[x] != i:
                continue
            maybe = (component != component[x]) & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
            maybe &= block == j if i != j else np.arange(len(ids)) > x
            maybe &= ~(bands[:, :band] == bands[x, :band]).any(axis=1)
            for y in np.flatnonzero(maybe).tolist():
                shared = len(sets_[x] & sets_[y])
                if 100 * shared >= percent * (size[x] + size[y] - shared):
                    found_a.append(min(ids[x], ids[y]))
                    found_b.append(max(ids[x], ids[y]))
        kind = members.schema.field("id").type
        return pa.table({"a": pa.array(found_a, kind), "b": pa.array(found_b, kind)})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, f"a {id_type}, b {id_type}")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, bands: int = BANDS, width: int = BAND_ROWS
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (least id reachable, itself included) and ``kept`` for every row."""
    rows = staged(sketched(docs, key, text, bands, width).withColumnRenamed(key, "id"))
    solid = rows.where("n_shingles > 0 and id is not null")
    classes = solid.groupBy("class").agg(F.min("id").alias("rep"))
    members = staged(solid.select("id", "class").join(classes, "class").select("id", "rep").distinct())
    # an id on rows with different texts joins their classes
    links = members.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    own = members.where("id = rep").select("id").distinct()
    entries = solid.join(own, "id").select("id", F.posexplode("bands").alias("band", "key")).select(
        "id", F.xxhash64("band", "key").alias("key")
    )
    shared = entries.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    buckets = staged(entries.join(shared.select("key"), "key").select("key", "id"))
    texts = staged(
        docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(buckets.select("id").distinct(), "id", "left_semi")
    )
    lows = buckets.groupBy("key").agg(F.min("id").alias("a"))
    pairs = buckets.join(lows, "key").where("id > a").select("a", F.col("id").alias("b")).distinct()
    links = staged(links.unionByName(verified(pairs, texts, percent)))
    labels = staged(components(links))
    # what is left: pairs of other members whose components differ
    rest = buckets.join(lows, "key").where("id > a").join(labels, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    rest = staged(rest.join(mixed, "key"))
    more = staged(blockwise(rest, texts, percent, bands, width))
    reach = components(links.unionByName(more))
    best = members.groupBy("id").agg(F.min("rep").alias("rep"))
    labelled = best.join(reach.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", F.least(F.coalesce("component", "rep"), "rep").alias("component_id")
    )
    return (
        rows.select("id", "n_shingles").join(labelled, "id", "left")
        .withColumn("component_id", F.coalesce("component_id", "id"))
        .select(F.col("id").alias(key), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
