"""Dictionary matcher: which curated entries an article mentions, and how often.

Aliases are counted one by one and summed per entry, so overlapping aliases add up.  Two exact strategies
share that contract:

* ``inline`` (small dictionaries): every alias is searched for in the texts of an Arrow batch, and the
  characters around it tell whether it counts.  One narrow stage, no explode of the text, no join, no shuffle.
* ``join`` (large dictionaries): the n-grams of each text are equi-joined with the alias table, so the cost
  does not grow with the dictionary.  The alias side is broadcast only if Spark finds it small enough.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strings
from ..sources.dictionary import KeywordConfig, lookup

INLINE_LIMIT = 400  # aliases; beyond this the generated projection gets unwieldy
WORD = r"[\p{L}\p{N}_]"
TOKEN = r"[^ -]+|[ -]"

ARTICLE = ("raw_noticia_id", "noticia_hash", "month_start", "source_media")
HIT = (
    "keyword", "normalized_keyword", "canonical_keyword", "normalized_canonical_keyword", "keyword_type",
    "extractor_source", "score", "occurrences", "hit_order",
)


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def count_words(text: str, words: str) -> int:
    """Occurrences of some words between word boundaries (a hyphen is one), leftmost first and without overlaps."""
    n, at = 0, text.find(words)
    while at >= 0:
        end = at + len(words)
        if (at and _is_word(text[at - 1])) or (end < len(text) and _is_word(text[end])):
            end = at
        else:
            n += 1
        at = text.find(words, max(end, at + 1))
    return n


def alias_occurrences(document: Column, names: list[list[str]]) -> Column:
    """(at, n) of the lists of aliases, by their place, that a text mentions: how often, summed over a list's aliases."""

    def count(texts: pa.Array) -> pa.Array:
        counted = [
            [(at, n) for at, aliases in enumerate(names) if (n := sum(count_words(text, a) for a in aliases))]
            for text in strings(texts)
        ]
        return pa.array(
            [[{"at": at, "n": n} for at, n in row] for row in counted], pa.list_(pa.struct({"at": pa.int32(), "n": pa.int64()}))
        )

    return F.arrow_udf(count, "array<struct<at:int,n:bigint>>")(document)


def dictionary_hits(documents: DataFrame, config: KeywordConfig, strategy: str | None = None) -> DataFrame:
    """Hits of the enabled entries. ``documents`` carries the article columns and ``normalized_document``."""
    enabled = [e for e in config.entries if e["enabled"]]
    aliases = sum(len(e["normalized_aliases"]) for e in enabled)
    strategy = strategy or ("inline" if aliases <= INLINE_LIMIT else "join")
    counted = (_inline if strategy == "inline" else _ngram_join)(documents, enabled)
    return counted.select(
        *ARTICLE,
        F.col("canonical").alias("keyword"),
        F.col("normalized").alias("normalized_keyword"),
        F.col("canonical").alias("canonical_keyword"),
        F.col("normalized").alias("normalized_canonical_keyword"),
        "keyword_type",
        F.lit("dictionary").alias("extractor_source"),
        (1 + F.col("priority") / 100.0).alias("score"),
        F.col("occurrences").cast("int").alias("occurrences"),
        F.col("position").cast("int").alias("hit_order"),
    )


def _inline(documents: DataFrame, entries: list[dict]) -> DataFrame:
    described = F.array(*[
        F.struct(*[F.lit(e[name]).alias(name) for name in ("position", "canonical", "normalized", "keyword_type", "priority")])
        for e in entries
    ])
    if not entries:
        described = F.expr("cast(array() as array<struct<position:int,canonical:string,normalized:string,keyword_type:string,priority:int>>)")
    # The function stands within inline, so that Spark does not call it a second time to leave out texts without a hit.
    found = documents.select(
        *ARTICLE, F.inline(alias_occurrences(F.col("normalized_document"), [e["normalized_aliases"] for e in entries]))
    )
    entry = F.get(described, F.col("at"))
    return found.select(*ARTICLE, entry.alias("e"), F.col("n").alias("occurrences")).select(*ARTICLE, "e.*", "occurrences")


def _ngram_join(documents: DataFrame, entries: list[dict]) -> DataFrame:
    spark = documents.sparkSession
    aliases = lookup(
        spark, [(e["position"], a) for e in entries for a in e["normalized_aliases"]],
        "position int, normalized_alias string",
    )
    aliases = aliases.select(
        "position", "normalized_alias",
        F.size(F.regexp_extract_all("normalized_alias", F.lit(TOKEN), F.lit(0))).alias("width"),
        F.startswith("normalized_alias", F.lit("-")).alias("opens_with_hyphen"),
        F.endswith("normalized_alias", F.lit("-")).alias("ends_with_hyphen"),
    )
    widths = sorted({len(_tokens(a)) for e in entries for a in e["normalized_aliases"]})
    is_word = lambda token: F.coalesce(~token.isin(" ", "-"), F.lit(False))

    # One row per token with those after it, made of shifted copies of the list: no function runs for every window.
    tokenised = documents.select(
        *ARTICLE, F.regexp_extract_all("normalized_document", F.lit(TOKEN), F.lit(0)).alias("tokens")
    )
    shifted = [F.slice("tokens", i + 1, F.size("tokens")).alias(f"t{i}") for i in range(max(widths, default=0) + 1)]
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("tokens")).alias("before")
    placed = tokenised.select(*ARTICLE, F.posexplode(F.arrays_zip(before, *shifted)).alias("at", "z"))
    token = lambda i: F.col(f"z.t{i}")
    # an alias neither begins nor ends with a space; null where the text ends before the window does
    grams = F.array(*[
        F.when(token(w - 1) != " ", F.struct(
            F.concat(*[token(i) for i in range(w)]).alias("gram"), is_word(token(w)).alias("word_after")
        ))
        for w in widths
    ])
    windows = placed.filter(token(0) != " ").select(
        *ARTICLE, "at", is_word(F.col("z.before")).alias("word_before"), F.inline(grams)
    ).filter("gram IS NOT NULL")
    matches = windows.join(aliases, windows["gram"] == aliases["normalized_alias"]).filter(
        ~(F.col("opens_with_hyphen") & F.col("word_before")) & ~(F.col("ends_with_hyphen") & F.col("word_after"))
    )
    # Matches of one alias must not overlap (leftmost first): fold over its positions within the article.
    greedy = F.aggregate(
        F.array_sort("starts"),
        F.struct(F.lit(-1).alias("next_free"), F.lit(0).alias("n")),
        lambda acc, at: F.when(
            at >= acc["next_free"], F.struct((at + F.col("width")).alias("next_free"), (acc["n"] + 1).alias("n"))
        ).otherwise(acc),
        lambda acc: acc["n"],
    )
    per_alias = matches.groupBy(*ARTICLE, "position", "normalized_alias", "width").agg(
        F.collect_list("at").alias("starts")
    ).select(*ARTICLE, "position", greedy.alias("n"))
    per_entry = per_alias.groupBy(*ARTICLE, "position").agg(F.sum("n").alias("occurrences"))
    described = lookup(
        spark, [(e["position"], e["canonical"], e["normalized"], e["keyword_type"], e["priority"]) for e in entries],
        "position int, canonical string, normalized string, keyword_type string, priority int",
    )
    return per_entry.join(described, "position")


def _tokens(alias: str) -> list[str]:
    import re

    return re.findall(TOKEN, alias)


def alias_counts(documents: DataFrame, aliases: list[str]) -> DataFrame:
    """Occurrences per article and alias, zero included (the scalar matcher on its own)."""
    found = alias_occurrences(F.col("normalized_document"), [[a] for a in aliases])
    counted = documents.select("raw_noticia_id", F.map_from_entries(found).alias("found"))
    names = F.posexplode(F.array(*map(F.lit, aliases))).alias("at", "normalized_alias")
    return counted.select("raw_noticia_id", "found", names).select(
        "raw_noticia_id", "normalized_alias", F.coalesce(F.col("found")[F.col("at")], F.lit(0)).cast("int").alias("occurrences")
    )
