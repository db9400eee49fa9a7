"""Keyword configuration: the YAML file, its DataFrames, and the sync into the stored dictionary."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.text import fold_label, normalize_text, tidy_label

SAMPLE_CONFIG = Path(__file__).resolve().parents[1] / "conf" / "keywords_sample.yml"

ENTRY_DDL = (
    "position int, canonical string, normalized string, keyword_type string, category string, "
    "priority int, enabled boolean, aliases array<string>, normalized_aliases array<string>"
)

def lookup(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Configured rows as a table whose size Spark knows, so that a small one is broadcast."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)


@dataclass(frozen=True)
class KeywordConfig:
    """Curated entries in file order, and the normalised phrases to drop."""

    entries: tuple[dict, ...]
    omitted: frozenset[str]

    def entries_df(self, spark: SparkSession) -> DataFrame:
        columns = [c.split()[0] for c in ENTRY_DDL.split(", ")]
        return lookup(spark, [tuple(e[c] for c in columns) for e in self.entries], ENTRY_DDL)

    def omitted_df(self, spark: SparkSession) -> DataFrame:
        return lookup(spark, [(o,) for o in sorted(self.omitted)], "normalized_keyword string")

    def dictionary_df(self, spark: SparkSession) -> DataFrame:
        """The configuration in the shape of the stored dictionary table; a repeated keyword is refreshed."""
        latest = KeywordConfig(tuple({e["normalized"]: e for e in self.entries}.values()), self.omitted)
        return latest.entries_df(spark).select(
            F.col("canonical").alias("canonical_keyword"),
            F.col("normalized").alias("normalized_keyword"),
            "keyword_type", "category", "priority", "enabled",
            F.lit("config").alias("source"),
        )

    def alias_map(self) -> dict[str, dict]:
        """Normalised alias to entry over the enabled entries; on duplicates the later entry wins."""
        return {a: e for e in self.entries if e["enabled"] for a in e["normalized_aliases"]}


def _column(records: list[dict], field: str, otherwise=None) -> list:
    return [record.get(field) or otherwise for record in records]


def load_keyword_config(path: str | Path) -> KeywordConfig:
    """Read the YAML configuration once, on the driver. A missing file raises ``FileNotFoundError``.

    The file's records become a table of entries and a table of spellings (entry, place, spelling).  The name of an
    entry that its aliases do not repeat takes the place before them; of spellings that fold alike the first counts.
    """
    import yaml

    content = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    records = [r for r in content.get("entries") or [] if tidy_label(r.get("canonical"))]
    entries = pd.DataFrame({
        "canonical": [tidy_label(r["canonical"]) for r in records],
        "keyword_type": _column(records, "type", "topic"),
        "category": pd.Series(_column(records, "category"), dtype=object),
        "priority": [int(p) for p in _column(records, "priority", 0)],
        "enabled": [bool(r.get("enabled", True)) for r in records],
    })
    entries["normalized"] = entries["canonical"].map(fold_label)
    listed = pd.Series(_column(records, "aliases", []), dtype=object).explode().dropna().rename("spelling").reset_index()
    listed["spelling"] = listed["spelling"].map(tidy_label)
    own = entries["canonical"].rename("spelling").reset_index()
    own = own[~own.apply(tuple, axis=1).isin(set(listed.itertuples(index=False, name=None)))] if len(own) else own
    spellings = pd.concat([own, listed]).query("spelling != ''").sort_values("index", kind="stable")
    spellings["folded"] = spellings["spelling"].map(fold_label)
    distinct = spellings.query("folded != ''").drop_duplicates(["index", "folded"])
    entries["aliases"] = spellings.groupby("index")["spelling"].agg(list).reindex(entries.index)
    entries["normalized_aliases"] = [
        found if isinstance(found, list) else [] for found in distinct.groupby("index")["folded"].agg(list).reindex(entries.index)
    ]
    omitted = {fold_label(phrase) for phrase in content.get("omitted_keywords") or []}
    return KeywordConfig(tuple({"position": i, **e} for i, e in enumerate(entries.to_dict("records"))), frozenset(omitted - {""}))


def dictionary_aliases(entries: DataFrame) -> DataFrame:
    """One row per entry and normalised alias, in entry and alias order."""
    return entries.select(
        "position", "canonical", "normalized", "keyword_type", "category", "priority", "enabled",
        F.posexplode("normalized_aliases").alias("alias_position", "normalized_alias"),
    )


def sync_dictionary(stored: DataFrame, config: DataFrame) -> DataFrame:
    """Stored dictionary after the config is applied: refresh, add, and disable what the config dropped.

    Entries are never deleted, and rows that did not come from the config are not disabled.
    """
    s, c = stored.alias("s"), config.alias("c")
    joined = s.join(c, F.col("s.normalized_keyword") == F.col("c.normalized_keyword"), "full_outer")
    in_config = F.col("c.normalized_keyword").isNotNull()

    def pick(name: str):
        return F.when(in_config, F.col(f"c.{name}")).otherwise(F.col(f"s.{name}")).alias(name)

    dropped = ~in_config & (F.col("s.source") == "config")
    return joined.select(
        pick("canonical_keyword"), pick("normalized_keyword"), pick("keyword_type"), pick("category"),
        pick("priority"),
        F.when(in_config, F.col("c.enabled")).when(dropped, F.lit(False)).otherwise(F.col("s.enabled"))
        .alias("enabled"),
        F.coalesce("s.source", "c.source").alias("source"),
    )


def config_aliases(entries: DataFrame) -> DataFrame:
    """Alias table rows of the configuration; on a duplicate alias the last one in file order wins."""
    pairs = entries.select(
        F.col("normalized").alias("normalized_keyword"), "enabled", "position",
        F.posexplode("aliases").alias("alias_position", "alias"),
    )
    # several spellings may share one normalised alias, so each spelling is normalised on its own
    named = pairs.withColumn("normalized_alias", normalize_text(F.col("alias"))).filter("normalized_alias != ''")
    order = F.struct("position", "alias_position")
    return named.groupBy("normalized_alias").agg(
        F.max_by("normalized_keyword", order).alias("normalized_keyword"),
        F.max_by("alias", order).alias("alias"),
        F.max_by("enabled", order).alias("enabled"),
    ).select("normalized_keyword", "alias", "normalized_alias", "enabled")


def sync_aliases(stored: DataFrame, config: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Stored aliases after the config is applied; aliases of config entries that vanished are disabled."""
    from_config = dictionary.filter(F.col("source") == "config").select("normalized_keyword").distinct()
    gone = stored.join(config, "normalized_alias", "left_anti")
    disabled = gone.join(from_config, "normalized_keyword", "left_semi").withColumn("enabled", F.lit(False))
    untouched = gone.join(from_config, "normalized_keyword", "left_anti")
    return config.unionByName(disabled).unionByName(untouched)
