"""Times the headline queries; prints one JSON line.

Every query runs once to warm the session up (class loading, code generation)
and once for the record; results go to Spark's no-op sink, so all rows and
columns are computed.
"""

from __future__ import annotations

import json
import os
import time

from fluxwatch.plans.catalog import QUERIES
from fluxwatch.session import local_session

HEADLINE = [
    "flow_alerts", "flow_feature_table", "rule_classify", "rule_alerts", "flow_stats_10s", "flow_stats_total",
    "running_rates", "bandwidth", "bandwidth_split", "decode_strict", "detected_alerts", "alerts_union",
    "attached_metadata", "classification_metrics", "latest_alerts", "rf_predict", "ar1_ols", "forecasts",
    "variance_run", "forecast_anomalies", "variance_anomalies", "model_table", "stream_flow_stats", "stream_alerts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            begun = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begun, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "cpus": cpus,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
