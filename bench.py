"""Times the headline queries; prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES set the run."""

from __future__ import annotations

import json
import os
import time

from tendersift.plans.catalog import QUERIES
from tendersift.session import build_session

HEADLINE = (
    "screen_verdicts", "verdict_counts", "dedup_first", "dedup_last", "recurring_need", "recurring_marked",
    "never_qualifies", "any_term", "word_term", "terms_found", "enumeration_only", "keyword_in_context",
    "skill_report", "topic_counts_zero_fill", "term_join", "notice_domain", "notice_domain_words", "notice_screening",
    "title_normalised", "folded_key", "freshness_window", "mixed_date_formats", "deadline_filters", "amount_ranges",
    "code_prefixes", "ledger_join", "two_key_lookup", "upsert", "merge_counts", "stale_removed", "first_last_seen",
    "best_block_cosine", "judge_batches", "judge_fallback", "audit_alerts", "score_bands", "threshold_sweep",
    "page_links", "file_links", "page_text", "payload_values", "header_carry", "numbered_rows", "stream_daily_counts",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus), "bench", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["work_list"](spark, sf).write.format("noop").mode("overwrite").save()  # session warm-up, not timed
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "headline queries, wall clock", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
