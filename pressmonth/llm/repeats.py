"""Removal of passages that occurred before: seeds from winnowed anchors, extended both ways to maximal repeats.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A window is ``window`` consecutive words of one document; a word goes if
some window over it has the words of a window that starts earlier (at a smaller id, or earlier in the same document),
judged on the input.

*Seed.*  Every window names an anchor: the rightmost of its ``seed``-word grams with the least hash.  The choice depends
on the window's words alone, so equal windows name equal anchors at the same offset.  Windows in a row that name one
anchor form a run; only runs (about one for eight words) are joined on anchors, windows are not.

*Extend.*  A run's context, all words its windows touch, is the anchor extended both ways.  Of equal runs (same anchor,
same place in the same context) all but the first go whole.  Tasks combine equal runs before they are dealt by ranges of
(anchor, context), so a passage in very many documents sends a few rows a task, and the contexts of a frequent anchor
are split over many tasks.  Of exact copies only the first is looked into.  Where an anchor has several contexts, the
first run of each is extended window by window, by a grouping on (anchor, window).  No two documents are ever paired,
and no group is collected.  Documents get back which of their runs and windows are first; all others go.

*Keep.*  The words removed, joined into maximal spans, are the maximal repeats of at least ``window`` words.

Runs and windows are told apart by two independent 64-bit hashes.  Rows that share an id but not the text are documents
of their own, ordered by a 36-bit hash of the text; rows that repeat id and text are one document and get the same result.  A
null id comes before all others.  Null and empty texts have no words.  An empty table gives no rows.  Only id and text
are read, so no other column can clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pressmonth.llm.arrays import Words, mix, slices, span_hashes, span_sums, text_bytes, words
from pressmonth.llm.staging import widened

WINDOW_WORDS, SEED_WORDS = 20, 5
BLOCK_RUNS = 500_000  # combined in a task before they are dealt
_PLACES = (1 << 28) - 1  # words of one slice; the other bits of a number that holds a place are a hash
_PLACE = np.uint64(_PLACES)


@dataclass
class Runs:
    """Windows in a row that share their anchor: document row, number in it, first window, windows, hashes."""

    row: np.ndarray
    number: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    context: np.ndarray
    offset: np.ndarray  # of the anchor in the first window
    sums: np.ndarray


def runs_of(found: Words, window: int, seed: int) -> Runs:
    total, sums = len(found.hash), span_sums(found.hash)
    if total < window:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64), none, sums)
    at = np.arange(total - seed + 1)
    grams = span_hashes(sums, at, at + seed, 21)
    least = (grams & ~_PLACE) | (_PLACE - at.astype(np.uint64))  # of equal hashes the rightmost is least
    width, wanted = 1, window - seed + 1
    while 2 * width <= wanted:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if wanted > width:
        least = np.minimum(least[: width - wanted], least[wanted - width :])
    place = (_PLACE - (least & _PLACE)).astype(np.int64)
    inside = np.flatnonzero(found.row[: total - window + 1] == found.row[window - 1 :])
    place = place[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1)
    heads = np.flatnonzero(new)
    first, place = inside[heads], place[heads]
    windows = np.diff(np.append(heads, len(inside)))
    row = found.row[first]
    number = np.arange(len(heads)) - np.searchsorted(row, row)
    context = span_hashes(sums, first, first + windows - 1 + window, 22)
    offset = place - first
    return Runs(row, number, first, windows, grams[place], mix(context + offset.astype(np.uint64), 23), offset, sums)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        for piece in slices(batch):
            yield piece, words(*text_bytes(piece.column("text")))


def _flat(lists: pa.Array, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the elements of a list column; a null list has none."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(rows), lengths), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _marked(lists: pa.Array, runs: Runs, rows: int) -> np.ndarray:
    """For each run 0 (not the first of its kind), 1 (the first) or 2 (the first, with other contexts of its anchor)."""
    row, mark = _flat(lists, rows)
    state = np.zeros(len(runs.row), np.int64)
    state[np.searchsorted(runs.row, row) + (mark >> 1)] = 1 + (mark & 1)
    return state


def _windows(runs: Runs, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, first word) of every window of the chosen runs."""
    count = runs.windows[chosen]
    run = np.repeat(chosen, count)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    return run, runs.first[run] + step


def _placed(piece: pa.RecordBatch, row: np.ndarray, at: np.ndarray) -> pa.Array:
    """The print of each row's document (its low bits are free) with a place in the document."""
    return pa.array(piece.column("print").to_numpy(zero_copy_only=False)[row] | at)


def _new(rows: pa.Table, *names: str) -> np.ndarray:
    """Rows that differ from the one before in one of the columns; the first one counts as new."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in names:
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def _first_marks(rows: pa.Table, alone: np.ndarray) -> pa.RecordBatch:
    """Document and mark of first runs: their number in it, and a low bit if the anchor has other contexts."""
    place = rows.column("place").to_numpy()
    mark = ((place & _PLACES) * 2 + ~alone).astype(np.int32)
    ids = rows.column("id").combine_chunks()
    return pa.RecordBatch.from_arrays([ids, pa.array(place & ~_PLACES), pa.array(mark)], ["id", "print", "mark"])


def _same(id_: Column, other: str) -> Column:
    return id_.eqNullSafe(F.col(other))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_words``, ``n_removed``, ``removed`` (maximal word spans) and ``kept`` (words joined by a space) of every row."""
    prints = F.xxhash64(text).bitwiseAND(F.lit(~_PLACES))
    texts = docs.select(F.col(key).alias("id"), prints.alias("print"), F.col(text).alias("text"))
    ids = texts.select("id").schema
    hashes = [StructField(name, LongType(), False) for name in ("place", "anchor", "content")]
    keyed = StructType([*ids.fields, *hashes])
    # exact copies: the first stands for all, in the others every window came before
    copies = texts.groupBy(F.md5(F.col("text").cast("binary"))).agg(F.min(F.struct("id", "print")).alias("first"))
    originals = copies.select(F.col("first.id").alias("own_id"), F.col("first.print").alias("own_print")).distinct()
    own = texts.join(originals, _same(F.col("id"), "own_id") & (F.col("print") == F.col("own_print")), "left_semi")

    order = ["anchor", "content", "id", "place"]

    def combined(blocks: list[pa.RecordBatch]) -> pa.RecordBatch:
        """The first of the runs that share anchor and context."""
        rows = pa.Table.from_batches(blocks).combine_chunks()
        rows = rows.take(pc.sort_indices(rows, [(name, "ascending") for name in order], null_placement="at_start"))
        return rows.filter(pa.array(_new(rows, "anchor", "content"))).combine_chunks().to_batches()[0]

    def find_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held = [], 0
        for piece, found in _pieces(batches):
            runs = runs_of(found, window, seed)
            if not len(runs.row):
                continue
            blocks.append(pa.RecordBatch.from_arrays([
                piece.column("id").take(pa.array(runs.row)), _placed(piece, runs.row, runs.number),
                pa.array(runs.anchor.view(np.int64)), pa.array(runs.context.view(np.int64)),
            ], keyed.names))
            held += len(runs.row)
            if held >= BLOCK_RUNS:
                yield combined(blocks)
                blocks, held = [], 0
        if blocks:
            yield combined(blocks)

    def first_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of sorted runs the first of each context, and whether its anchor has others: a neighbour tells.

        The ends of a range may have neighbours in the next one; they count as having others, which costs a look at
        their windows and changes no result.
        """
        last, alone = None, False  # the context seen last, and whether the one before it has another anchor
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            new = np.flatnonzero(_new(rows, "anchor", "content"))
            rows = rows.take(pa.array(new))
            apart = _new(rows, "anchor")  # from the one before
            apart[0] = alone
            yield _first_marks(rows.slice(0, len(new) - 1), apart[:-1] & apart[1:])
            last, alone = rows.slice(len(new) - 1).combine_chunks().to_batches()[0], bool(apart[-1])
        if last is not None:
            yield _first_marks(pa.Table.from_batches([last]), np.zeros(1, bool))

    runs = own.mapInArrow(find_runs, keyed).repartitionByRange("anchor", "content").sortWithinPartitions(*order)
    firsts = runs.mapInArrow(first_runs, widened(ids, print="bigint", mark="int")).groupBy(
        F.col("id").alias("run_id"), F.col("print").alias("run_print")
    ).agg(F.collect_list("mark").alias("first_runs"))
    marked = texts.join(
        firsts, _same(F.col("id"), "run_id") & (F.col("print") == F.col("run_print")), "left"
    ).drop("run_id", "run_print")

    def find_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _pieces(batches):
            runs = runs_of(found, window, seed)
            open_ = np.flatnonzero(_marked(piece.column("first_runs"), runs, piece.num_rows) == 2)
            run, start = _windows(runs, open_)
            content = span_hashes(runs.sums, start, start + window, 24)
            row = runs.row[run]
            yield pa.RecordBatch.from_arrays([
                piece.column("id").take(pa.array(row)), _placed(piece, row, start - np.searchsorted(found.row, row)),
                pa.array(runs.anchor[run].view(np.int64)), pa.array(content.view(np.int64)),
            ], keyed.names)

    opened = marked.mapInArrow(find_windows, keyed)
    opened = opened.groupBy("anchor", "content").agg(F.min(F.struct("id", "place")).alias("first"))
    number = F.col("first.place").bitwiseAND(F.lit(_PLACES))
    windows = opened.groupBy(
        F.col("first.id").alias("window_id"), F.col("first.place").bitwiseAND(F.lit(~_PLACES)).alias("window_print")
    ).agg(F.collect_list(number.cast("int")).alias("first_windows"))
    judged = marked.join(
        windows, _same(F.col("id"), "window_id") & (F.col("print") == F.col("window_print")), "left"
    ).select("id", "text", "first_runs", "first_windows")  # a copy has none, so all its windows go

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _pieces(batches):
            runs = runs_of(found, window, seed)
            state = _marked(piece.column("first_runs"), runs, piece.num_rows)
            goes = np.zeros(len(found.hash) + 1, bool)  # windows, by their first word
            goes[_windows(runs, np.flatnonzero(state != 1))[1]] = True
            row, at = _flat(piece.column("first_windows"), piece.num_rows)
            goes[np.searchsorted(found.row, row) + at] = False
            starts = np.flatnonzero(goes)
            cover = np.zeros(len(found.hash) + 1, np.int64)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            yield pa.RecordBatch.from_arrays([
                piece.column("id"), pa.array(found.counts, pa.int64()),
                pa.array(np.bincount(found.row[gone], minlength=piece.num_rows), pa.int64()),
                _spans(found, gone), _joined(found, ~gone),
            ], ["id", "n_words", "n_removed", "removed", "kept"])

    schema = widened(
        ids, n_words="bigint", n_removed="bigint", removed="array<struct<first:int,end:int>>", kept="string"
    )
    return judged.mapInArrow(cut, schema).withColumnRenamed("id", key)


def _spans(found: Words, gone: np.ndarray) -> pa.Array:
    """Maximal spans of removed words of each document, by their place in it."""
    at = np.flatnonzero(gone)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (found.row[at[1:]] != found.row[at[:-1]])
    heads = np.flatnonzero(new)
    first, row = at[heads], found.row[at[heads]]
    length = np.diff(np.append(heads, len(at)))
    first = first - np.searchsorted(found.row, row)
    spans = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(first + length, pa.int32())], ["first", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(found.rows + 1)), pa.int32()), spans)


def _joined(found: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    start, length, row = found.start[keep], (found.end - found.start)[keep] + 1, found.row[keep]
    begins = np.cumsum(length) - length
    source = np.repeat(start - begins, length) + np.arange(int(length.sum()))
    joined = np.append(found.data, np.uint8(32))[source]
    joined[begins + length - 1] = 32
    sizes = np.bincount(row, weights=length, minlength=found.rows).astype(np.int64)
    last = np.cumsum(sizes)[sizes > 0] - 1
    joined = np.delete(joined, last)
    ends = np.append(0, np.cumsum(np.maximum(sizes - 1, 0)))
    return pa.StringArray.from_buffers(
        found.rows, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(joined.tobytes())
    )
