"""Time the headline queries: one warm-up and one measured run each.

Prints one JSON line.  BENCH_SF_DIR picks the folder, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import logging
import os
import time

from corpuscle.plans import all_queries
from corpuscle.session import build_session

HEADLINE = """
popular_documents mention_extract dominant_mention article_pairing citation_dedupe
name_cleaning duplicate_merge dictionary_mentions topic_score topic_distribution
status_cascade status_buckets unresolved_ranking fact_upsert dim_merge_fill bridge_replace
consolidated_documents repointed_links incremental_intake patience_stop search_questions
fold_search facets nested_histogram cited_parts_ranking citation_view question_catalogue
level_explode document_coverage key_checks carry_forward auto_numbering clause_extraction
version_diff citation_compare cosine_pairs grade_summary quote_location column_profile
line_filter paragraph_lines page_blocks question_split
""".split()


def run(query, spark, folder: str) -> float:
    began = time.perf_counter()
    query.run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    known = all_queries()
    times = {}
    for name in HEADLINE:
        if name in known:
            run(known[name], spark, folder)
            times[name] = round(run(known[name], spark, folder), 3)
    print(json.dumps({
        "metric": "headline_queries_warm_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
