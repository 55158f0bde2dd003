"""Time the headline queries; prints one JSON line.

Each query is built, planned and run to the end (every row is produced) twice;
the better time counts, so the first compilation does not.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from surveyloom.session import build_session

HEADLINE = (
    "survey_frequency pre_post_report missing_stats free_text_compliance survey_header flatten_values read_responses "
    "question_tables drop_incomplete_questions latest_valid_per_name match_cascade fuzzy_candidates "
    "matched_pre_post clean_text remove_emojis translate_columns strip_html contacts_upsert list_elements"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
