"""Named-entity hits: an annotator proposes mentions, Spark filters, normalises and counts them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, fold_label, normalize_text, strings
from ..schemas import ENTITY_LABELS
from .matching import ARTICLE

# Runs of capitalised words; the character before a run is consumed in place of a look-behind.  The
# quantifiers are possessive: a run of any length is matched by a loop, not by recursion on the stack.
CAPITALISED_RUN = r"(?:^|[^\p{L}\p{N}_])(\p{Lu}[\p{L}\p{N}]*+(?: \p{Lu}[\p{L}\p{N}]*+)*+)"

Annotator = Callable[[list[str]], list[list[tuple[str, str]]]]


MENTIONS = "array<struct<normalized:string,n:bigint,first:struct<at:int,text:string>,last:struct<at:int,label:string>>>"

_folded = lru_cache(maxsize=100_000)(fold_label)


def _count(mentions: pa.Array) -> pa.Array:
    """The mentions of each article by their normalised form, labelled MISC: how many, the first and the last."""
    texts, at = list(strings(mentions.flatten())), 0
    ends, forms, spelled, n, first, last = [0], [], [], [], [], []
    for length in pc.list_value_length(mentions).fill_null(0).to_pylist():
        known: dict[str, int] = {}
        for place, text in enumerate(texts[at : at + length]):
            form = _folded(text)
            row = known.setdefault(form, len(forms))
            if row == len(forms):
                forms.append(form)
                spelled.append(text)
                n.append(0)
                first.append(place)
                last.append(place)
            n[row] += 1
            last[row] = place
        at += length
        ends.append(len(forms))
    places = [pa.array(p, pa.int32()) for p in (first, last)]
    label = pa.array(["MISC"] * len(forms), pa.string())
    rows = pa.StructArray.from_arrays(
        [pa.array(forms, pa.string()), pa.array(n, pa.int64()),
         pa.StructArray.from_arrays([places[0], pa.array(spelled, pa.string())], ["at", "text"]),
         pa.StructArray.from_arrays([places[1], label], ["at", "label"])],
        ["normalized", "n", "first", "last"],
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def capitalised_mentions(document: Column) -> Column:
    """Default annotator: every run of capitalised words, counted in the article's row."""
    return F.arrow_udf(_count, MENTIONS)(F.regexp_extract_all(document, F.lit(CAPITALISED_RUN), F.lit(1)))


def annotated_mentions(documents: DataFrame, load_annotator: Callable[[], Annotator]) -> DataFrame:
    """Mentions found by a user's model, which each Python worker loads once.

    ``load_annotator()`` returns a function from a batch of texts to ``(text, label)`` lists.
    """
    keep = documents.select(*ARTICLE, "document")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema if f.name in ARTICLE)

    def annotate(batches: Iterator) -> Iterator:
        import pandas as pd

        model = load_annotator()
        for batch in batches:
            found = model(batch["document"].tolist())
            rows = batch[list(ARTICLE)].assign(
                mentions=[[(i, t, label) for i, (t, label) in enumerate(m)] for m in found]
            )
            rows = rows.explode("mentions").dropna(subset=["mentions"])
            parts = pd.DataFrame(rows.pop("mentions").tolist(), columns=["at", "text", "label"], index=rows.index)
            yield pd.concat([rows, parts], axis=1)

    return keep.mapInPandas(annotate, f"{schema}, at int, text string, label string")


def entity_hits(
    documents: DataFrame, load_annotator: Callable[[], Annotator] | None = None, min_chars: int = 3
) -> DataFrame:
    """One hit per article and normalised mention: first spelling, last label, number of mentions."""
    if load_annotator is None:
        # Only distinct mentions become rows; they hold letters, digits and single spaces, and are clean already.
        # An article moves as one row; inline_outer, for which Spark does not count a second time to leave out empty lists.
        listed = documents.select(*ARTICLE, capitalised_mentions(F.col("document")).alias("mentions")).repartition(ARTICLE[0])
        named = listed.select(*ARTICLE, F.inline_outer("mentions"))
    else:
        named = annotated_mentions(documents, load_annotator).filter(F.col("label").isin(*ENTITY_LABELS)).select(
            *ARTICLE, normalize_text(F.col("text")).alias("normalized"), F.lit(1).cast("bigint").alias("n"),
            F.struct("at", clean_text(F.col("text")).alias("text")).alias("first"), F.struct("at", "label").alias("last"),
        )
    counted = named.filter(F.length("normalized") >= min_chars).groupBy(ARTICLE[0], "normalized", *ARTICLE[1:]).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    return counted.select(
        *ARTICLE,
        F.col("first.text").alias("keyword"),
        F.col("normalized").alias("normalized_keyword"),
        F.lit(None).cast("string").alias("canonical_keyword"),
        F.lit(None).cast("string").alias("normalized_canonical_keyword"),
        F.lower("last.label").alias("keyword_type"),
        F.lit("spacy").alias("extractor_source"),
        F.lit(1.0).alias("score"),
        F.col("n").cast("int").alias("occurrences"),
        F.col("first.at").cast("int").alias("hit_order"),
    )
