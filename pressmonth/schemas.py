"""Declared schemas (Spark DDL) of the upstream table and of every table the pipeline keeps."""

NEWS_COLUMNS = {
    "id": "bigint",
    "upstream_id": "bigint",
    "noticia_hash": "string",
    "fuente": "string",
    "url_original": "string",
    "titulo": "string",
    "texto_completo": "string",
    "url_imagen": "string",
    "fecha_publicacion": "timestamp_ntz",
    "fecha_extraccion": "timestamp_ntz",
    "embedding": "array<float>",
    "synced_at": "timestamp_ntz",
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


UPSTREAM = ddl({k: v for k, v in NEWS_COLUMNS.items() if k not in ("upstream_id", "synced_at")})

_HIT = {
    "keyword": "string",
    "normalized_keyword": "string",
    "canonical_keyword": "string",
    "normalized_canonical_keyword": "string",
    "keyword_type": "string",
}

TABLES: dict[str, str] = {
    "raw_news": ddl({**NEWS_COLUMNS, "month_start": "date"}),
    "processing_runs": ddl({
        "run_id": "string", "stage": "string", "run_type": "string", "status": "string",
        "started_at": "timestamp_ntz", "finished_at": "timestamp_ntz", "lookback_hours": "int",
        "rows_detected": "bigint", "notes": "string",
    }),
    "affected_periods": ddl({
        "processing_run_id": "string", "year": "int", "month": "int", "month_start": "date",
        "status": "string", "reason": "string", "rows_detected": "bigint", "updated_at": "timestamp_ntz",
    }),
    "keyword_dictionary": ddl({
        "canonical_keyword": "string", "normalized_keyword": "string", "keyword_type": "string",
        "category": "string", "priority": "int", "enabled": "boolean", "source": "string",
    }),
    "keyword_aliases": ddl({
        "normalized_keyword": "string", "alias": "string", "normalized_alias": "string", "enabled": "boolean",
    }),
    "news_keywords": ddl({
        "raw_noticia_id": "bigint", "noticia_hash": "string", "month_start": "date", **_HIT,
        "extractor_source": "string", "score": "decimal(12,6)", "occurrences": "int", "source_media": "string",
    }),
    "news_keyword_processing": ddl({
        "raw_noticia_id": "bigint", "month_start": "date", "status": "string", "keyword_rows": "int",
        "updated_from_run_id": "string", "processed_at": "timestamp_ntz",
    }),
    "monthly_keyword_stats": ddl({
        "month_start": "date", **_HIT, "extractor_sources": "array<string>", "news_count": "int",
        "total_occurrences": "int", "avg_score": "decimal(12,6)", "source_media_count": "int",
        "source_media_stats": "map<string,int>", "priority": "int",
    }),
    "daily_activity": ddl({"month_start": "date", "activity_date": "date", "news_count": "int"}),
    "source_keyword_stats": ddl({
        "month_start": "date", "source_media": "string", **_HIT, "news_count": "int",
        "total_occurrences": "int", "avg_score": "decimal(12,6)",
    }),
    "source_monthly_stats": ddl({
        "month_start": "date", "source_media": "string", "news_count": "int", "keyword_rows": "int",
        "distinct_keywords": "int",
        "top_keywords": "array<struct<keyword:string,news_count:int,total_occurrences:int>>",
    }),
    "monthly_overview": ddl({
        "month_start": "date", "total_news": "int", "news_with_keywords": "int", "active_source_count": "int",
        "keyword_count": "int",
        "top_keywords": "array<struct<keyword:string,type:string,news_count:int,total_occurrences:int>>",
        "source_stats": "array<struct<source_media:string,news_count:int,distinct_keywords:int>>",
        "first_publication_at": "timestamp_ntz", "last_publication_at": "timestamp_ntz",
    }),
    "source_aliases": ddl({"source_name": "string", "alias": "string", "created_at": "timestamp_ntz"}),
}

# Business key of each table (its unique constraint).
KEYS: dict[str, tuple[str, ...]] = {
    "raw_news": ("noticia_hash",),
    "processing_runs": ("run_id",),
    "affected_periods": ("month_start", "reason"),
    "keyword_dictionary": ("normalized_keyword",),
    "keyword_aliases": ("normalized_alias",),
    "news_keywords": ("raw_noticia_id", "normalized_keyword", "extractor_source"),
    "news_keyword_processing": ("raw_noticia_id",),
    "monthly_keyword_stats": ("month_start", "normalized_keyword"),
    "monthly_overview": ("month_start",),
    "daily_activity": ("month_start", "activity_date"),
    "source_monthly_stats": ("month_start", "source_media"),
    "source_keyword_stats": ("month_start", "source_media", "normalized_keyword"),
    "source_aliases": ("source_name",),
}

# Tables stored one directory per month; the others are small state tables kept as whole snapshots.
MONTHLY_TABLES = frozenset(
    name for name, columns in TABLES.items() if "`month_start`" in columns and name != "affected_periods"
)

# Domains of the coded columns.
PERIOD_STATUSES = ("pending", "processing", "completed", "consumed", "failed", "skipped")
RUN_TYPES = ("full", "incremental")
RUN_STATUSES = ("running", "completed", "failed")
MARKER_STATUSES = ("completed", "failed")
EXTRACTORS = ("dictionary", "spacy", "yake")
ENTITY_LABELS = ("PER", "LOC", "ORG", "MISC")
