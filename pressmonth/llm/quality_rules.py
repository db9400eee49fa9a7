"""Quality rules: counted base rules and a calibrated logistic regression on hashed n-grams.

The base rules count words, lines and repeated eight-word windows of the whole text exactly (windows are found by
hash and confirmed word by word).  The classifier is trained on a bounded sample of labelled rows, calibrated by
Platt scaling on a part of the sample kept from training, and scores Arrow batches; a text passes with a probability
of at least ``threshold``.

Null and empty texts have no words and fail the base rules.  Without labels of both kinds the classifier passes all
texts (probability 1), so the base rules alone decide.  Equal texts get equal results.  An empty table gives no rows.
Of the input only the id is carried, so no other column can clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.arrays import Words, mix, slices, text_bytes, words
from pressmonth.llm.features import LinearModel, collected, descend, one_label, platt, sample_features, sample_of, sigmoid
from pressmonth.llm.staging import widened

SAMPLE_ROWS = 1500  # labelled rows of each label that the classifier is fitted on
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
THRESHOLD = 0.3
SYMBOLS = b"#*$%&|<>"


def repeated_words(found: Words, size: int = WINDOW_WORDS) -> np.ndarray:
    """By row: words that lie in a ``size``-word window found twice or more in the row's text."""
    total = np.zeros(found.rows, np.int64)
    count = len(found.hash) - size + 1
    if count <= 0:
        return total
    starts = np.flatnonzero(found.row[:count] == found.row[size - 1 :])
    value = np.zeros(len(starts), np.uint64)
    for k in range(size):
        value = mix(value + found.hash[starts + k], 50 + k)
    value = mix(value + found.row[starts].astype(np.uint64), 60)
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    same = np.zeros(len(ordered), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    same[:-1] |= same[1:]
    hits = np.sort(starts[order[same]])
    raw = found.data.tobytes()
    text = {int(h): (found.row[h], b" ".join(raw[found.start[h + k] : found.end[h + k]] for k in range(size))) for h in hits}
    seen: dict = {}
    for window in text.values():
        seen[window] = seen.get(window, 0) + 1
    marked = np.zeros(len(found.hash) + 1, np.int64)
    confirmed = np.array([h for h, window in text.items() if seen[window] > 1], np.int64)
    marked[confirmed] += 1
    np.add.at(marked, confirmed + size, -1)
    inside = np.cumsum(marked[:-1]) > 0
    return np.bincount(found.row[inside], minlength=found.rows)


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of the base rules for each row of a slice."""
    found = words(data, offsets)
    rows = found.rows
    of_byte = np.repeat(np.arange(rows), np.diff(offsets))
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    chars = np.bincount(of_byte[solid & ((data & 0xC0) != 0x80)], minlength=rows)
    symbols = np.bincount(of_byte[np.isin(data, np.frombuffer(SYMBOLS, np.uint8))], minlength=rows)
    duplicates = np.zeros(rows, np.int64)
    raw = data.tobytes()
    breaks = np.bincount(of_byte[data == 10], minlength=rows)
    for r in np.flatnonzero(breaks):
        lines = [line for line in raw[offsets[r] : offsets[r + 1]].split(b"\n") if line.strip(b" \t\n\r\v\f")]
        duplicates[r] = len(lines) - len(set(lines))
    return {
        "n_words": found.counts, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": duplicates,
        "n_repeat_words": repeated_words(found),
    }


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, sample_rows: int = SAMPLE_ROWS) -> LinearModel | None:
    """The calibrated classifier, or None without labels of both kinds.

    Both labels are sampled alike; the calibration weighs them back to their shares of all labelled rows.
    """
    known = one_label(labels, key, label)
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    chosen = sample_of(known.where("y = 1"), sample_rows, key, 1).unionByName(sample_of(known.where("y = 0"), sample_rows, key, 1))
    held = docs.select(key, text).join(F.broadcast(chosen), key)  # 2 * sample_rows ids at most
    _, y, sample = collected(sample_features(held, text, [key, "y"]), key, "y")
    y = y.astype(np.float64)
    if not 0 < y.sum() < len(y):
        return None
    weight = np.where(y > 0, sizes[1] / y.sum(), sizes[0] / (len(y) - y.sum()))
    middle = len(y) * 3 // 4
    weights, bias = descend(sample.rows(0, middle), lambda z, own: (sigmoid(z) - y[own]) / len(z))
    judged = slice(middle, len(y)) if 0 < y[middle:].sum() < len(y) - middle else slice(0, len(y))
    z, own = sample.scores(weights, bias)[judged], weight[judged]
    a, b = platt(z, y[judged], own / own.sum() * len(z))
    return LinearModel(a * weights * sample.scale, a * bias + b)


def quality_rules(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``key``, the base counts, ``base_failed``, ``probability`` and ``kept`` for every row."""
    model = fit(docs, labels, label, key, text, sample_rows)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = widened(
        docs.select(key).schema, **dict.fromkeys(counts, "bigint"), base_failed="boolean", probability="double", kept="boolean"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                data, offsets = text_bytes(piece.column(text))
                found = base_counts(data, offsets)
                failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])
                good = model.score(data, offsets) if model else np.ones(piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(key), *(pa.array(found[c], pa.int64()) for c in counts), pa.array(failed),
                     pa.array(good), pa.array(~failed & (good >= threshold))],
                    schema.names,
                )

    return docs.select(key, text).mapInArrow(run, schema)
