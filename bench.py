"""Time the headline queries; prints one JSON line."""

import json
import os
import time

from pressmonth.plans.catalog import QUERIES
from pressmonth.plans.lineage import drop_staged
from pressmonth.session import local_session

HEADLINE = (
    "scan_valid_news", "incremental_news", "daily_activity", "affected_periods", "normalize_text", "dictionary_hits",
    "entity_hits", "keyphrase_hits", "news_keywords", "monthly_keyword_stats", "source_keyword_stats",
    "source_monthly_stats", "monthly_overview", "topic_news", "resolve_keyword_batch", "month_over_month",
    "related_keywords", "nearest_articles",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, cores, os.environ.get("BENCH_MEMORY", "16g"))
    QUERIES["daily_activity"](spark, directory).collect()  # JVM warm-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }))
    drop_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()
