"""Order-preserving packing of documents into fixed windows by dynamic programming.

The documents of an input partition, in their order, form one token stream.  A window may end at a document end
(free), at a sentence end, or, inside a longer stretch without one, at a grid place; the last two cost a truncation
penalty, counted in tokens like padding.  With f the least cost up to a place and window W,

    f(j) = min over i with place(j) - place(i) <= W of f(i) + W - (place(j) - place(i)) + penalty(j)

and because the padding is linear, the minimum of f(i) + place(i) over the sliding range is kept by a monotone
queue: one pass, whatever the number of choices.  The stream is handled in runs of a few megabytes of text; what
the best cut leaves over is carried into the next run, so only the end of a partition is padded beyond the optimum,
and there a window whose length splits into few powers of two is split instead (such windows need no padding).

No shuffle: partitions pack independently, and a lost one is recomputed from its own input alone.

A null or empty text is a document of the end mark alone; equal rows are packed each; a null id stays null; an
empty table gives no pieces.  Only ``doc_id`` is carried from the input, so no other column can clash.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from pressmonth.llm.arrays import slices
from pressmonth.llm.staging import widened

WINDOW = 2048
END_ID = 1
SENTENCE_PENALTY = 4
GRID_PENALTY = 24
GRID = 32  # places offered inside a stretch of more than twice as many tokens without a sentence end
CACHE_WORDS = 250_000  # bounds a worker's memory; words not met among the last half of so many are tokenized again
SLICE_TEXT = 6 << 20  # bytes of text handled at once

_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")  # fixed by the vocabulary
_PLAIN = regex.compile(r"[\x21-\x7eÀ-ɏ]*")
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_SENTENCE_END = r"[.!?…][\"'”’»)\]]*$"


class ChunkTokens:
    """Ids of texts by their space-separated chunks: no word of this vocabulary crosses white space.

    The distinct chunks of a slice are found by Arrow, split into the vocabulary's words, and only words not yet
    seen by this worker reach the tokenizer; ids are then gathered by numpy.  Known words are kept in two generations:
    when the younger is full it becomes the older one, from which words still in use are taken over.
    """

    def __init__(self, tokenizer_file: str):
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.word: dict[str, int] = {}
        self.ids, self.first = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)  # of each word, and the end of the last
        self._grow_old()

    def _grow_old(self) -> None:
        self.old_word, self.old_ids, self.old_first = self.word, self.ids, self.first
        self.word, self.ids, self.first = {}, np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        known, used = len(self.word), int(self.first[-1])
        self.word.update(zip(words, range(known, known + len(words))))
        self.first = np.append(self.first, used + np.cumsum(sizes))
        while self.first[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : self.first[-1]] = ids

    def _learn(self, missing: set[str]) -> None:
        again = list(missing & self.old_word.keys())
        if again:
            old = np.fromiter(map(self.old_word.__getitem__, again), np.int64, len(again))
            sizes = self.old_first[old + 1] - self.old_first[old]
            self._add(again, self.old_ids[_ranges(self.old_first[old], sizes)], sizes)
        words = list(missing - self.old_word.keys())
        if words:
            coded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
            self._add(words, coded.ids, np.bincount(np.array(coded.word_ids, np.int64), minlength=len(words)))

    def _words_of(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all chunks, flat, and how many each has."""
        plain = pc.ascii_is_alpha(chunks)  # one word each; the others are split one by one
        simple = pc.ascii_lower(chunks.filter(plain)).to_pylist()
        plain = plain.to_numpy(zero_copy_only=False)
        flat: list[str] = []
        split: list[int] = []
        for chunk in chunks.filter(pa.array(~plain)).to_pylist():
            before = len(flat)
            if chunk.isascii() or _PLAIN.fullmatch(chunk):
                core = chunk.rstrip(_TAIL)
                if core.isalpha():
                    flat.append(core.lower())
                    if core != chunk:
                        flat.append(chunk[len(core) :])
                elif chunk != "\n":
                    flat += _WORDS.findall(chunk.lower())
            else:
                flat.append(chunk)
            split.append(len(flat) - before)
        missing = set(simple).union(flat) - self.word.keys()
        if missing:
            self._learn(missing)
        number = self.word.__getitem__
        counts = np.ones(len(plain), np.int64)
        counts[~plain] = split
        first = np.cumsum(counts) - counts
        numbers = np.empty(int(counts.sum()), np.int64)
        numbers[first[plain]] = np.fromiter(map(number, simple), np.int64, len(simple))
        numbers[_ranges(first[~plain], counts[~plain])] = np.fromiter(map(number, flat), np.int64, len(flat))
        return numbers, counts

    def stream(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end mark; token counts; places after a sentence end)."""
        if len(self.word) > CACHE_WORDS // 2:
            self._grow_old()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not pc.all(pc.string_is_ascii(texts)).as_py():
            texts = pc.utf8_normalize(texts, form="NFC")
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        coded = split.flatten().dictionary_encode()
        flat, counts = self._words_of(coded.dictionary)
        closing = pc.or_(pc.match_substring_regex(coded.dictionary, _SENTENCE_END), pc.equal(coded.dictionary, "\n"))
        closes = np.append(closing.to_numpy(zero_copy_only=False).astype(bool), False)
        # ids of each distinct chunk, side by side, and the end mark as the last chunk
        word_sizes = np.diff(self.first)[flat]
        pool = np.append(self.ids[_ranges(self.first[flat], word_sizes)], np.uint32(END_ID))
        chunk_first = np.cumsum(counts) - counts
        ends = np.append(0, np.cumsum(word_sizes))
        chunk_sizes = np.append(ends[chunk_first + counts] - ends[chunk_first], 1)
        pool_first = np.cumsum(chunk_sizes) - chunk_sizes
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        index = np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(per_text), len(coded.dictionary))
        sizes = chunk_sizes[index]
        after = np.cumsum(sizes)
        ids = pool[_ranges(pool_first[index], sizes)]
        lengths = np.diff(after[np.cumsum(per_text + 1) - 1], prepend=0)
        return ids, lengths, after[closes[index]]


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places first[k] .. first[k] + sizes[k] - 1 of all k, one after the other."""
    after = np.cumsum(sizes)
    return np.repeat(first - (after - sizes), sizes) + np.arange(after[-1] if len(after) else 0)


@lru_cache(maxsize=2)
def chunk_tokens(tokenizer_file: str) -> ChunkTokens:
    return ChunkTokens(tokenizer_file)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])]


def candidates(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Places where a window may end, in order from 0 to ``total``, and their penalties."""
    known = _distinct(np.concatenate([[0, total], doc_ends, sentence_ends]))
    known = known[(known >= 0) & (known <= total)]
    gaps = np.diff(known)
    grid = [np.arange(known[g] + GRID, known[g + 1], GRID) for g in np.flatnonzero(gaps > 2 * GRID)]
    places = _distinct(np.concatenate([known, *grid]))
    cost = np.full(len(places), GRID_PENALTY)
    cost[np.searchsorted(places, known)] = SENTENCE_PENALTY
    free = np.concatenate([[0], doc_ends[(doc_ends >= 0) & (doc_ends <= total)]])
    cost[np.searchsorted(places, free)] = 0
    return places.tolist(), cost.tolist()


def best_cuts(places: list[int], penalties: list[int], window: int, final: bool) -> list[int]:
    """Places of the cheapest cuts from 0 on: to the last place if ``final``, else to the best one within a window of it."""
    cost, back = [0] * len(places), [0] * len(places)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, index), costs rising
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0][1]] < place - window:
            queue.popleft()
        least, i = queue[0]
        cost[j] = here = least + window - place + penalties[j]
        back[j] = i
        here += place
        while queue and queue[-1][0] >= here:
            queue.pop()
        queue.append((here, j))
    j = len(places) - 1
    if not final:
        low = places[-1] - window
        j = min((k for k in range(len(places) - 1, -1, -1) if places[k] >= low), key=cost.__getitem__, default=j)
    cuts = [places[j]]
    while j:
        j = back[j]
        cuts.append(places[j])
    return cuts[::-1]


def split_powers(cuts: list[int], window: int) -> list[int]:
    """Windows split into powers of two where that costs less than their padding."""
    out = cuts[:1]
    for start, end in zip(cuts, cuts[1:]):
        length = end - start
        powers = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
        if length < window and (len(powers) - 1) * GRID_PENALTY < window - length:
            for power in powers[:-1]:
                start += power
                out.append(start)
        out.append(end)
    return out


def pack(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, with_ids: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: where each lies in its document and in its window, a CRC of its ids, and the ids."""
    places = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = widened(docs.select(key).schema, **dict.fromkeys(places, "bigint"), **({"ids": "array<int>"} if with_ids else {}))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = chunk_tokens(tokenizer_file)
        sequence = TaskContext.get().partitionId() << 40
        # the stream not yet cut: its ids, and of each document the key, the first place (negative once cut) and length
        ids, doc_start, doc_size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        sentences, keys = np.zeros(0, np.int64), None

        def commit(final: bool) -> pa.RecordBatch:
            nonlocal ids, doc_start, doc_size, sentences, keys, sequence
            cuts = best_cuts(*candidates(len(ids), doc_start + doc_size, sentences), window, final)
            if final:
                cuts = split_powers(cuts, window)
            bounds = np.array(cuts)
            starts = _distinct(np.concatenate([bounds[:-1], doc_start[(doc_start >= 0) & (doc_start < bounds[-1])]]))
            stops = np.append(starts[1:], bounds[-1])
            doc = np.searchsorted(doc_start, starts, side="right") - 1
            seq = np.searchsorted(bounds, starts, side="right") - 1
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
            columns = [keys.take(pa.array(doc))] + [
                pa.array(c, pa.int64())
                for c in (starts - doc_start[doc], stops - starts, crcs, doc_size[doc], sequence + seq, starts - bounds[seq])
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, bounds[-1]), pa.int32()), pa.array(ids[: bounds[-1]].astype(np.int32))))
            sequence += len(cuts) - 1
            left = doc_start + doc_size > bounds[-1]
            ids, sentences = ids[bounds[-1] :], sentences[sentences > bounds[-1]] - bounds[-1]
            doc_start, doc_size, keys = doc_start[left] - bounds[-1], doc_size[left], keys.filter(pa.array(left))
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            for piece in slices(batch, text, SLICE_TEXT):
                more, sizes, ends = coder.stream(piece.column(text))
                new = piece.column(key)
                keys = new if keys is None else pa.concat_arrays([keys, new])
                doc_start = np.append(doc_start, len(ids) + np.cumsum(sizes) - sizes)
                doc_size = np.append(doc_size, sizes)
                sentences = np.append(sentences, ends + len(ids))
                ids = np.append(ids, more)
                if len(ids) > 200 * window:
                    yield commit(False)
        if len(ids):
            yield commit(True)

    return docs.select(key, text).mapInArrow(run, schema)
