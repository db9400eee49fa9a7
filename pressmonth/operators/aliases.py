"""Stable anonymous names of the sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import number_by

PREFIX = "Fuente "


def new_aliases(sources: DataFrame, stored: DataFrame) -> DataFrame:
    """Aliases for the sources that have none yet, numbered by name after the highest stored number."""
    highest = stored.filter(F.col("alias").like(PREFIX + "%")).agg(F.coalesce(
        F.max(F.replace("alias", F.lit(PREFIX), F.lit("")).cast("int")), F.lit(0)
    ))
    unknown = sources.select(F.col("source_media").alias("source_name")).filter(
        F.col("source_name").isNotNull()
    ).distinct().join(stored.select("source_name"), "source_name", "left_anti")
    number = (F.col("number") + highest.scalar()).cast("bigint").cast("string")
    return number_by(unknown, "source_name").select(
        "source_name", F.concat(F.lit(PREFIX), number).alias("alias")
    )


def source_aliases(sources: DataFrame, stored: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Alias table after the sources of a run were seen: stored aliases stay, new sources are appended."""
    added = new_aliases(sources, stored)
    if "created_at" in stored.columns:
        added = added.withColumn("created_at", F.lit(now).cast("timestamp_ntz"))
    return stored.unionByName(added)


def public_name(strict: bool) -> Column:
    """Alias to display.  ``strict`` never falls back to the real name."""
    return F.col("alias") if strict else F.coalesce("alias", "source_media")


def with_alias(rows: DataFrame, aliases: DataFrame, strict: bool = False) -> DataFrame:
    """Rows with the public name of their ``source_media`` in ``alias``."""
    names = aliases.select(F.col("source_name").alias("source_media"), "alias")
    return rows.join(names, "source_media", "left").withColumn("alias", public_name(strict))
