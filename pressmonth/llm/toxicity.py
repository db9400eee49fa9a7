"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, with evidence.

Terms are lower-cased words and their beginnings of 4, 6 and 8 bytes.  The examples are a bounded sample of labelled rows;
every term of theirs is in the vocabulary, and its document frequency is counted over all documents.  Example vectors
lie in an inverted index.  Lists of rare terms are short and are added up whole; the lists of frequent terms are cut
into blocks of examples, each with its greatest weight, so a search visits blocks by falling bound and stops when no
bound can beat the k-th best similarity: the result equals a full scan (to 7 digits; blocks are in single precision).  The vote of the neighbours is weighted by
similarity (and by how thinly each label was sampled) over a fixed prior mass; a logistic curve fitted on leave-one-out
votes of the sample turns it into a probability.  The nearest example ids are the evidence.

Vectors range over the examples' terms: a word that no example holds changes no order of neighbours.  Null and empty
texts and texts without any such term have no neighbours and get the prior's probability.  Without labels of both kinds
every score is the share of label 1 (0 without labels).  Equal texts get equal scores.  Of rows that repeat an
example's id the least text counts.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.arrays import lowered, slices, span_hashes, span_sums, text_bytes, words
from pressmonth.llm.features import one_label, platt, sample_of, sigmoid
from pressmonth.llm.staging import staged, widened

SAMPLE_ROWS = 2000  # labelled rows of each label: the examples
PREFIXES = (4, 6, 8)
NEIGHBOURS, EVIDENCE = 25, 5
PRIOR_MASS = 1.0
BLOCK = 64  # examples
FREQUENT = 16  # a term that one of so many examples holds has its list in blocks
SEARCHED, POSTINGS = 128, 2_000_000  # documents and list entries of one step of a search
SLACK = 1e-6  # covers the rounding of sums
REJECT = 0.3


@dataclass
class Terms:
    """Distinct words of a slice with their terms, and how often each row holds each word."""

    word: np.ndarray  # of each term, rising
    hash: np.ndarray
    pair_row: np.ndarray
    pair_word: np.ndarray
    pair_count: np.ndarray


def terms(data: np.ndarray, offsets: np.ndarray) -> Terms:
    """Words without the marks around them; their beginnings are hashed once for each distinct word."""
    data = lowered(data)
    found = words(data, offsets)
    inner = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    place = np.arange(len(data))
    last = np.maximum.accumulate(np.where(inner, place, -1)) if len(data) else place
    first = np.minimum.accumulate(np.where(inner, place, len(data))[::-1])[::-1] if len(data) else place
    start, end = first[found.start], last[found.end - 1] + 1
    solid = (start < end) & (start >= found.start) & (end <= found.end)
    row, start, end = found.row[solid], start[solid], end[solid]
    sums = span_sums(data.astype(np.uint64) + np.uint64(1))
    whole, at, word = np.unique(span_hashes(sums, start, end, 1), return_index=True, return_inverse=True)
    start, end = start[at], end[at]
    owners, hashes = [np.arange(len(whole))], [whole]
    for size in PREFIXES:
        longer = np.flatnonzero(end - start > size)
        owners.append(longer)
        hashes.append(span_hashes(sums, start[longer], start[longer] + size, size))
    owner, value = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owner, kind="stable")
    pairs, counts = np.unique(row * max(len(whole), 1) + word, return_counts=True)
    pair_row, pair_word = np.divmod(pairs, max(len(whole), 1))
    return Terms(owner[order], value[order], pair_row, pair_word, counts)


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [first, first + size), one range after the other."""
    done = np.cumsum(size)
    return np.arange(done[-1] if len(done) else 0) + np.repeat(first - done + size, size)


def counted_terms(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number in the sorted vocabulary, count) of the known terms, by row and number."""
    if not len(vocabulary):
        return (np.zeros(0, np.int64),) * 3
    found = terms(data, offsets)
    # a table of the hashes' high bits drops most unknown terms before the search
    gate = np.zeros(1 << 22, bool)
    gate[(vocabulary >> np.uint64(42)).astype(np.int64)] = True
    maybe = np.flatnonzero(gate[(found.hash >> np.uint64(42)).astype(np.int64)])
    value = found.hash[maybe]
    at = np.minimum(np.searchsorted(vocabulary, value), len(vocabulary) - 1)
    known = vocabulary[at] == value
    word, at = found.word[maybe[known]], at[known]
    first = np.searchsorted(word, found.pair_word)
    size = np.searchsorted(word, found.pair_word, side="right") - first
    cell = np.repeat(found.pair_row, size) * len(vocabulary) + at[spread(first, size)]
    cells, place = np.unique(cell, return_inverse=True)
    counts = np.bincount(place, np.repeat(found.pair_count, size), len(cells))
    return (*np.divmod(cells, len(vocabulary)), counts)


def term_hashes(docs: DataFrame, text: str) -> DataFrame:
    """The distinct terms of all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(terms(*text_bytes(piece.column(text))).hash).view(np.int64))], ["term"])

    return docs.select(text).mapInArrow(run, "term bigint").distinct()


def document_frequencies(docs: DataFrame, text: str, vocabulary: np.ndarray) -> DataFrame:
    """(term, documents): of all documents, added up in each task before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for piece in slices(batch, text):
                total += np.bincount(counted_terms(*text_bytes(piece.column(text)), vocabulary)[1], minlength=len(vocabulary))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["term", "documents"])

    return docs.select(text).mapInArrow(run, "term int, documents bigint").groupBy("term").agg(F.sum("documents").alias("documents"))


def vectors(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors of a slice: (first entry of each row, term numbers, weights)."""
    rows = len(offsets) - 1
    row, at, counts = counted_terms(data, offsets, vocabulary)
    weight = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt(np.bincount(row, weight * weight, rows))
    return np.searchsorted(row, np.arange(rows + 1)), at, weight / norm[row] if len(row) else weight


@dataclass
class BlockMaxIndex:
    """Lists of the examples that hold each term; bounded by the sample."""

    count: int
    first: np.ndarray  # where each term's list begins
    examples: np.ndarray
    weights: np.ndarray
    blocks: tuple | None = None  # made where it is used: it is larger than the lists

    @classmethod
    def of(cls, starts: np.ndarray, at: np.ndarray, weight: np.ndarray, terms_: int) -> BlockMaxIndex:
        example = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        order = np.lexsort((example, at))
        return cls(len(starts) - 1, np.searchsorted(at[order], np.arange(terms_ + 1)), example[order], weight[order])

    def _blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of each frequent term or -1, weights by block, frequent term and example, greatest weight of each block)."""
        if self.blocks is None:
            size = np.diff(self.first)
            frequent = np.flatnonzero(size * FREQUENT > self.count)
            number = np.full(len(size), -1)
            number[frequent] = np.arange(len(frequent))
            width = -(-self.count // BLOCK) * BLOCK
            dense = np.zeros((len(frequent), width), np.float32)
            own = spread(self.first[frequent], size[frequent])
            dense[np.repeat(np.arange(len(frequent)), size[frequent]), self.examples[own]] = self.weights[own]
            dense = np.ascontiguousarray(dense.reshape(len(frequent), width // BLOCK, BLOCK).transpose(1, 0, 2))
            self.blocks = number, dense, np.ascontiguousarray(dense.max(axis=2).T) if len(frequent) else np.zeros((0, len(dense)))
        return self.blocks

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine (above 0) and their cosines, falling; equal ones by number."""
        return next(self.search(np.array([0, len(at)]), at, weight, k))

    def search(self, starts: np.ndarray, at: np.ndarray, weight: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """:meth:`nearest` of many vectors, some at a time."""
        number, _, _ = self._blocks()
        size = np.where(number[at] < 0, np.diff(self.first)[at], 0)
        effort = np.append(0, np.cumsum(size))[starts]
        lo = 0
        while lo < len(starts) - 1:
            hi = max(lo + 1, min(lo + SEARCHED, int(np.searchsorted(effort, effort[lo] + POSTINGS, side="right")) - 1))
            own = slice(starts[lo], starts[hi])
            yield from self._some(np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1])), at[own], weight[own], size[own], hi - lo, k)
            lo = hi

    def _some(self, row: np.ndarray, at: np.ndarray, weight: np.ndarray, size: np.ndarray, rows: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        number, dense, greatest = self._blocks()
        width = len(dense) * BLOCK
        entry = spread(self.first[at], size)
        scores = np.bincount(
            np.repeat(row * width, size) + self.examples[entry], np.repeat(weight, size) * self.weights[entry], rows * width
        ).astype(float).reshape(rows, width)  # whole numbers where nothing is added
        often = number[at] >= 0
        query = np.zeros((rows, len(greatest)), np.float32)
        query[row[often], number[at[often]]] = weight[often]
        bound = scores.reshape(rows, -1, BLOCK).max(axis=2) + query @ greatest
        seen = np.zeros(bound.shape, bool)
        ahead = min(bound.shape[1], 2 + k // BLOCK)
        need = np.zeros(bound.shape, bool)
        np.put_along_axis(need, np.argsort(-bound, axis=1, kind="stable")[:, :ahead], True, axis=1)
        while True:
            need &= bound > 0
            for block in np.flatnonzero(need.any(axis=0)).tolist():
                of, part = np.flatnonzero(need[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                scores[of, part] += query[of] @ dense[block]
            seen |= need
            final = np.where(np.repeat(seen, BLOCK, axis=1), scores, 0)
            least = np.partition(final, width - k, axis=1)[:, width - k] if width > k else np.zeros(rows)
            need = ~seen & (bound >= least[:, None] - SLACK) & (bound > 0)
            if not need.any():
                break
        for cosine, kth in zip(final, least):
            found = np.flatnonzero((cosine >= kth - SLACK) & (cosine > 0))
            cosine = np.round(cosine[found], 7)
            order = np.lexsort((found, -cosine))[:k]
            yield found[order], cosine[order]


@dataclass
class NeighbourModel:
    """The fitted index; its size is bounded by the sample and the vocabulary, not by the corpus."""

    vocabulary: np.ndarray
    idf: np.ndarray
    index: BlockMaxIndex
    ids: list
    label: np.ndarray
    mass: np.ndarray  # weight of each example's label in a vote
    base: float
    curve: tuple[float, float] = (1.0, 0.0)

    def vote(self, neighbours: np.ndarray, cosine: np.ndarray) -> float:
        weight = cosine * self.mass[neighbours]
        return float(((weight * self.label[neighbours]).sum() + PRIOR_MASS * self.base) / (weight.sum() + PRIOR_MASS))

    def judge(self, starts: np.ndarray, at: np.ndarray, weight: np.ndarray) -> list[tuple[float, list]]:
        """(probability, evidence) of each vector; one without terms has no neighbours."""
        return [
            (self._probability(self.vote(neighbours, cosine)), [self.ids[n] for n in neighbours[:EVIDENCE]])
            for neighbours, cosine in self.index.search(starts, at, weight, NEIGHBOURS)
        ]

    def _probability(self, vote: float) -> float:
        return float(sigmoid(np.array(self.curve[0] * vote + self.curve[1])))


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, sample_rows: int = SAMPLE_ROWS) -> NeighbourModel | float:
    """The model, or the share of label 1 where the labels are not of both kinds."""
    known = one_label(labels, key, label)
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return float(1 in sizes)
    chosen = sample_of(known.where("y = 1"), sample_rows, key, 1).unionByName(sample_of(known.where("y = 0"), sample_rows, key, 1))
    held = docs.select(key, text).join(F.broadcast(chosen), key)  # 2 * sample_rows ids at most
    held = staged(held.groupBy(key, "y").agg(F.min(text).alias(text)))
    drawn = {r["y"]: r["n"] for r in held.groupBy("y").agg(F.count("*").alias("n")).collect()}
    base = sizes[1] / (sizes[0] + sizes[1])
    if len(drawn) < 2:
        return base
    found = term_hashes(held, text).toArrow().column("term").to_numpy()  # of 2 * sample_rows texts
    vocabulary = np.sort(found.astype(np.int64).view(np.uint64))
    counted = document_frequencies(docs, text, vocabulary).toArrow()
    frequency = np.zeros(len(vocabulary))
    frequency[counted.column("term").to_numpy()] = counted.column("documents").to_numpy()
    idf = np.log((2 + docs.count()) / (1 + frequency))
    example_schema = widened(held.select(key, "y").schema, at="array<int>", weight="array<double>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                starts, at, weight = vectors(*text_bytes(piece.column(text)), vocabulary, idf)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(key), piece.column("y"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(at, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(weight))],
                    example_schema.names,
                )

    examples = held.mapInArrow(run, example_schema).toArrow().sort_by([(key, "ascending"), ("y", "ascending")])
    sizes_of = examples.column("at").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    starts = np.append(0, np.cumsum(sizes_of))
    at = examples.column("at").combine_chunks().flatten().to_numpy().astype(np.int64)
    weight = examples.column("weight").combine_chunks().flatten().to_numpy()
    # examples that share their commonest term lie together, so that a block's greatest weights tell something
    share = np.bincount(at, minlength=len(vocabulary))
    common = np.array([at[lo + share[at[lo:hi]].argmax()] if lo < hi else -1 for lo, hi in zip(starts[:-1], starts[1:])])
    order = np.argsort(common, kind="stable")
    entry = spread(starts[:-1][order], sizes_of[order])
    at, weight, starts = at[entry], weight[entry], np.append(0, np.cumsum(sizes_of[order]))
    y = examples.column("y").to_numpy().astype(np.float64)[order]
    ids = examples.column(key).take(pa.array(order)).to_pylist()
    del examples, found, counted, entry, order
    pa.default_memory_pool().release_unused()  # the driver goes on to other jobs: what came to it as tables goes back
    mass = np.where(y > 0, sizes[1] / y.sum(), sizes[0] / max((1 - y).sum(), 1))
    mass /= mass.max()
    index = BlockMaxIndex.of(starts, at, weight, len(vocabulary))
    model = NeighbourModel(vocabulary, idf, index, ids, y, mass, base)
    votes = np.full(len(y), base)
    for e, (near, cosine) in enumerate(index.search(starts, at, weight, NEIGHBOURS + 1)):
        other = near != e
        votes[e] = model.vote(near[other][:NEIGHBOURS], cosine[other][:NEIGHBOURS])
    index.blocks = None
    model.curve = platt(votes, y, mass / mass.sum() * len(y))
    return model


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
    carry: list[str] | None = None, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The columns ``carry`` (all) of ``docs`` with ``toxicity`` and ``evidence`` (ids of the nearest examples)."""
    model = fit(docs, labels, label, key, text, sample_rows)
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("toxicity", "evidence")]
    key_type = docs.schema[key].dataType.simpleString()
    schema = widened(docs.select(*kept).schema, toxicity="double", evidence=f"array<{key_type}>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged: dict[bytes, tuple[float, list]] = {}  # equal texts are judged once
        for batch in batches:
            for piece in slices(batch, text):
                if isinstance(model, float):
                    found = [(model, [])] * piece.num_rows
                else:
                    starts, at, weight = vectors(*text_bytes(piece.column(text)), model.vocabulary, model.idf)
                    names = [
                        hashlib.blake2b(at[lo:hi].tobytes() + weight[lo:hi].tobytes(), digest_size=16).digest()
                        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist())
                    ]
                    if len(judged) > 20_000:
                        judged.clear()
                    new = {name: row for row, name in enumerate(names) if name not in judged}
                    rows = np.array(list(new.values()), np.int64)
                    size = np.diff(starts)[rows]
                    entry = spread(starts[rows], size)
                    judged.update(zip(new, model.judge(np.append(0, np.cumsum(size)), at[entry], weight[entry])))
                    found = [judged[name] for name in names]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in kept), pa.array([s for s, _ in found], pa.float64()),
                     pa.array([e for _, e in found], pa.list_(piece.schema.field(key).type))],
                    schema.names,
                )

    columns = list(dict.fromkeys([*kept, key, text]))
    return docs.select(*columns).mapInArrow(run, schema)
