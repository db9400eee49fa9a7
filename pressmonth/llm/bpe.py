"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

A long text is cut before a white-space character that follows a solid one: no match of the split pattern
crosses such a place (white space only ever begins a match there, and the part before it ends without the
white space that the pattern's look-ahead would inspect), so the ids of the parts joined are the ids of the
whole.  A stretch without such a place stays in one part.  Very long white space, on which the splitter's own
matching would run out of stack, is one match of the pattern, without its last character if a solid one follows, and is
encoded as that one piece.

Null texts count as empty; an empty text has no ids; repeated rows are encoded each; extra columns pass.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from pressmonth.llm.arrays import slices
from pressmonth.llm.staging import widened

PART_CHARS = 1 << 16
# white space and controls differ between regex engines: neither counts as the solid side of a cut
_CUT = regex.compile(r"[\p{L}\p{N}\p{P}\p{S}](?= )")

_LONG_BLANK = regex.compile(r"\p{White_Space}{50000,}")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` cut at safe places, each part about ``size`` characters or up to the next such place."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encode(coder: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PART_CHARS:
        return coder.encode_ordinary(text)
    ids, start = [], 0
    for blank in _LONG_BLANK.finditer(text):
        end = blank.end() - (blank.end() < len(text))
        ids += [i for part in parts(text[start : blank.start()]) for i in coder.encode_ordinary(part)]
        ids += coder._encode_single_piece(text[blank.start() : end])
        start = end
    return ids + [i for part in parts(text[start:]) for i in coder.encode_ordinary(part)]


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of the whole text in column ``ids`` (array of int)."""
    schema = widened(docs.drop(ids).schema, **{ids: "array<int>"})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(rank_file, pattern)
        for batch in batches:
            for piece in slices(batch, text):
                coded = [encode(coder, t or "") for t in piece.column(text).to_pylist()]
                kept = [n for n in piece.schema.names if n != ids]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(n) for n in kept] + [pa.array(coded, pa.list_(pa.int32()))], [*kept, ids]
                )

    return docs.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, rank_file: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the raw bytes of ``ids`` in ``decoded`` (binary: ids may cut a character); null ids give none."""
    schema = widened(rows.drop(decoded).schema, **{decoded: "binary"})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(rank_file, pattern)
        for batch in batches:
            column = batch.column(ids)
            kept = [n for n in batch.schema.names if n != decoded]
            for start in range(0, batch.num_rows, 500):
                raw = [coder.decode_bytes(x or []) for x in column.slice(start, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n).slice(start, 500) for n in kept] + [pa.array(raw, pa.binary())], [*kept, decoded]
                )

    return rows.mapInArrow(run, schema)


def encode_digests(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode, decode and digest in one pass: ``n_tokens``, SHA-256 of the ids as text and of the decoded bytes.

    The ids of a text live only inside its batch, so nothing wider than the digests leaves the task.
    """
    import hashlib

    names = [c for c in docs.columns if c != text]
    schema = widened(docs.select(*names).schema, n_tokens="bigint", ids_sha256="string", decoded_sha256="string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(rank_file, pattern)
        digits = [str(i) for i in range(coder.n_vocab)]
        for batch in batches:
            for piece in slices(batch, text):
                sizes, id_digests, byte_digests = [], [], []
                for value in piece.column(text).to_pylist():
                    ids = encode(coder, value or "")
                    sizes.append(len(ids))
                    id_digests.append(hashlib.sha256(" ".join([digits[i] for i in ids]).encode()).hexdigest())
                    byte_digests.append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(n) for n in names]
                    + [pa.array(sizes, pa.int64()), pa.array(id_digests, pa.string()), pa.array(byte_digests, pa.string())],
                    [*names, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.mapInArrow(run, schema)
