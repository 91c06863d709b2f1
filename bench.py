"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of local cores. Each query is run to its
last row; tables take the best of three runs, streams (which write state and results) run once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

TABLES = (
    "window_agg_by_location",
    "window_agg_panes",
    "window_agg_direct",
    "tumbling_agg",
    "encode_decode_json",
    "enrich_events",
    "rejects_by_reason",
    "csv_feed",
    "report_top20",
    "report_count",
    "feed_metrics",
)
STREAMS = (
    "stream_update_single_batch",
    "stream_append_closed",
    "stream_late_data",
    "latest_per_window",
    "raw_event_sink",
)


def main() -> None:
    from kerbflow.catalogue import QUERIES
    from kerbflow.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shuffle = int(cpus) if cpus.isdigit() else 8
    spark = build_session(
        "kerbflow-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=shuffle,
        **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    seconds = {name: round(min(timed(name) for _ in range(3)), 3) for name in TABLES}
    seconds |= {name: round(timed(name), 3) for name in STREAMS}
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    flagship = seconds["window_agg_by_location"]
    print(
        json.dumps(
            {
                "metric": "total_time_of_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "events": events,
                "flagship_events_per_sec": round(events / flagship),
                "cpus": cpus,
                "shuffle_partitions": shuffle,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
