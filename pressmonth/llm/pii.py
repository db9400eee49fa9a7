"""Personal data by bootstrapped contextual extraction.

Entities of fixed formats (e-mail addresses, IP addresses, payment cards, phone numbers, and credentials of known
form) are found in every text.  They also seed a pattern-instance graph: an instance is an identifier-like token (a
digit or an @ in it, six characters or more), a pattern is a lexical context of it with the token's coarse shape: the
word or the two words before it, or the token's own beginning up to "=" or ":" or its first four capitals.  In turns,
Spark rates each pattern by the belief in its distinct instances and each instance by its patterns.  Patterns of high
confidence then mark identifiers that no format knows.  All of them stay a table: the texts' (pattern, place) rows meet
it in a join, and what it marks meets the texts by their digest, so neither the driver nor a task holds all patterns.

Spans are code points, end exclusive.  Found spans never replace the format's own: one that overlaps such a span is
left out.  Null and empty texts have no spans; equal texts get equal spans; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.arrays import slices
from pressmonth.llm.staging import staged, widened

KINDS = ("email", "ip", "card", "phone", "secret")  # the order of kinds at one start
BASE_KINDS = KINDS[:4]
ROUNDS = 3
MIN_CONFIDENCE, MIN_SUPPORT = 0.9, 5.0
SALTS = 16  # parts of a frequent pattern's places, and of the copies of a text

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# a match can only begin at a digit that follows none: one that begins later in the run also begins at its start
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_SECRET = re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|(?i:\b(?:password|passwd|pwd|secret|token|api_?key)[ ]?[=:][ ]?[\"']?)([A-Za-z0-9+/_-]{8,})")
_TOKEN = re.compile(r"\S+")
_IDENTIFIER = re.compile(r"[0-9@]")
_EDGE = "\"'`()[]{}<>.,;:!?"


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # end of the last match
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four formats, by start and kind."""
    found = [(s, e, "email") for s, e in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        found += [(s, e, "ip") for s, e in ips(text)]
        found += [(s, e, "card") for s, e in cards(text)]
        if "+" in text:
            found += [(s, e, "phone") for s, e in phones(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def seed_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Base spans and credentials of known form that overlap none of them."""
    secrets = [m.span(1) if m[1] else m.span() for m in _SECRET.finditer(text)]
    return base + [(s, e, "secret") for s, e in secrets if not any(s < y and x < e for x, y, _ in base)]


def shape(token: str) -> str:
    """Coarse shape: which kinds of characters occur, and the length in steps of four."""
    kinds = (("A", str.isupper), ("a", str.islower), ("9", str.isdigit), ("-", lambda c: not c.isalnum()))
    return "".join(name for name, test in kinds if any(map(test, token))) + str(min(len(token) // 4, 8))


def contexts(before: list[str], token: str) -> list[str]:
    """The lexical patterns of a token."""
    form = shape(token)
    left = [w.strip(_EDGE).lower() for w in before]
    found = []
    if left and left[-1]:
        found.append(f"1 {left[-1]} {form}")
        if len(left) > 1 and left[-2]:
            found.append(f"2 {left[-2]} {left[-1]} {form}")
    own = re.match(r"[A-Za-z_]+[=:]", token)
    if own:
        found.append(f"own {own[0].lower()}")
    elif re.match(r"[A-Z]{4}", token):
        found.append(f"head {token[:4]} {form}")
    return found


def identifiers(text: str) -> Iterator[tuple[int, int, str, list[str]]]:
    """(start, end, token, patterns) of the identifier-like tokens; the end marks of a sentence are left out."""
    if not _IDENTIFIER.search(text):
        return
    before: list[str] = []
    for m in _TOKEN.finditer(text):
        token = m[0]
        if len(token) >= 6 and _IDENTIFIER.search(token):
            core = token.strip(_EDGE)
            if len(core) >= 6 and _IDENTIFIER.search(core):
                start = m.start() + token.index(core)
                yield start, start + len(core), core, contexts(before, core)
        before = [*before[-1:], token]


def edges(docs: DataFrame, text: str) -> DataFrame:
    """Distinct (pattern, instance, kind) of a task's slices; kind is the seed's, or null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                rows: set[tuple[str, bytes, str | None]] = set()
                for value in piece.column(text).to_pylist():
                    if not value or not _IDENTIFIER.search(value):
                        continue
                    seeds = seed_spans(value, base_spans(value))
                    for start, end, token, patterns in identifiers(value):
                        kind = next((k for s, e, k in seeds if s < end and start < e), None)
                        instance = hashlib.blake2b(token.encode(), digest_size=8).digest()
                        rows.update((p, instance, kind) for p in patterns)
                ordered = sorted(rows, key=lambda r: (r[0], r[1], r[2] or ""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in ordered], pa.string()), pa.array([r[1] for r in ordered], pa.binary()),
                     pa.array([r[2] for r in ordered], pa.string())],
                    ["pattern", "instance", "kind"],
                )

    return docs.select(text).mapInArrow(run, "pattern string, instance binary, kind string").distinct()


def digest(text: Column) -> Column:
    """What tells texts apart; a null text is empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def learn_patterns(
    docs: DataFrame, text: str = "text", rounds: int = ROUNDS, confidence: float = MIN_CONFIDENCE, support: float = MIN_SUPPORT
) -> DataFrame:
    """(pattern, kind) of all patterns of high confidence; of several kinds the one with most support, then the first by name."""
    graph = staged(edges(docs, text))
    links = graph.select("pattern", "instance").distinct()
    sizes = links.groupBy("pattern").agg(F.count("*").alias("size"))
    seeds = graph.where("kind is not null").select("instance", "kind").distinct().withColumn("belief", F.lit(1.0))
    beliefs, rated = seeds, None
    for _ in range(rounds):
        rated = (
            links.join(beliefs, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("support"))
            .join(sizes, "pattern").withColumn("confidence", F.col("support") / (F.col("size") + 1))
        )
        trusted = rated.where((F.col("support") >= support) & (F.col("confidence") >= 0.5)).select("pattern", "kind", "confidence")
        # an instance is believed unless all its trusted patterns fail; seeds stay certain
        doubt = F.exp(F.sum(F.log(F.lit(1.0) - F.least("confidence", F.lit(0.999)))))
        reached = links.join(trusted, "pattern").groupBy("instance", "kind").agg((F.lit(1.0) - doubt).alias("belief"))
        beliefs = staged(seeds.unionByName(reached).groupBy("instance", "kind").agg(F.max("belief").alias("belief")))
    best = rated.where((F.col("support") >= support) & (F.col("confidence") >= confidence)).groupBy("pattern")
    return staged(best.agg(F.min(F.struct(-F.col("support"), "kind")).alias("best")).select("pattern", "best.kind"))


def places(docs: DataFrame, text: str) -> DataFrame:
    """(text, start, end, turn, pattern): the patterns, in turn, of the identifiers outside all seeds, once for each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                rows: set[tuple[bytes, int, int, int, str]] = set()
                for value in piece.column(text).to_pylist():
                    if not value or not _IDENTIFIER.search(value):
                        continue
                    seeds = seed_spans(value, base_spans(value))
                    name = hashlib.md5(value.encode(), usedforsecurity=False).digest()
                    for start, end, _, patterns in identifiers(value):
                        if not any(s < end and start < e for s, e, _ in seeds):
                            rows.update((name, start, end, turn, p) for turn, p in enumerate(patterns))
                columns = list(zip(*sorted(rows))) or [()] * 5
                types = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["digest", "start", "end", "turn", "pattern"]
                )

    return docs.select(text).mapInArrow(run, "digest binary, start int, end int, turn int, pattern string").distinct()


def discovered(docs: DataFrame, patterns: DataFrame, text: str = "text") -> DataFrame:
    """(digest, found): the identifiers of each text that a pattern marks, as (start, end, kind); the first pattern decides."""
    # a frequent pattern's places lie in several parts, each with its own copy of the pattern's row
    dealt = places(docs, text).withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
    copied = patterns.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    kind = F.min(F.struct("turn", "kind"))["kind"]
    marked = dealt.join(copied, ["pattern", "salt"]).groupBy("digest", "start", "end").agg(kind.alias("kind"))
    return marked.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("found"))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each span (overlapping ones together) replaced by its kind in brackets."""
    out, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def find_pii(docs: DataFrame, text: str = "text", carry: list[str] | None = None, patterns: DataFrame | None = None) -> DataFrame:
    """The columns ``carry`` (all) with counts of the base kinds, ``base_sha256``, ``spans`` and ``redacted``.

    ``patterns`` (pattern, kind) are learned from ``docs`` where none are given.
    """
    found = staged(discovered(docs, learn_patterns(docs, text) if patterns is None else patterns, text))
    added = [*(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "redacted"]
    kept = [c for c in (docs.columns if carry is None else carry) if c not in added]
    extras = f"__found_{len(kept)}"
    schema = widened(docs.select(*kept).schema, **{c: "bigint" if c.startswith("n_") else "string" for c in added})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                counts, digests, strings, clean = [], [], [], []
                for value, extra in zip(piece.column(text).to_pylist(), piece.column(extras).to_pylist()):
                    base = base_spans(value or "")
                    spans = seed_spans(value or "", base) + [(f["start"], f["end"], f["kind"]) for f in extra or ()]
                    spans.sort(key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
                    counts.append([sum(k == kind for _, _, k in base) for kind in BASE_KINDS])
                    digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    strings.append(joined(spans))
                    clean.append(value if not spans else redacted(value, spans))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in kept), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)),
                     pa.array(digests, pa.string()), pa.array(strings, pa.string()), pa.array(clean, pa.string())],
                    schema.names,
                )

    columns = list(dict.fromkeys([*kept, text]))
    names = [f"__{name}_{len(columns)}" for name in ("digest", "salt")]
    # copies of a text lie in several parts, each with its own copy of what was found in it
    copied = found.select(F.col("digest").alias(names[0]), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(names[1]), F.col("found").alias(extras))
    others = [f"`{c}`" for c, of in docs.select(*columns).dtypes if c != text and "map<" not in of]  # a map has no hash
    part = F.pmod(F.xxhash64(F.lit(0), *others), F.lit(SALTS)).cast("int")
    dealt = docs.select(*columns, digest(F.col(text)).alias(names[0]), part.alias(names[1]))
    return dealt.join(copied, names, "left").select(*columns, extras).mapInArrow(run, schema)
