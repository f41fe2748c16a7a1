"""Time hot_items_top5 / hot_urls_top5 with Spark's window() and with panes.

Usage: python tools/window_plans.py [sf_dir]   (median of 3 after one warm-up)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.plans import hot  # noqa: E402
from eventide.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "16g"})
    out = {}
    for name, fn in (("hot_items_top5", hot.hot_items_top5), ("hot_urls_top5", hot.hot_urls_top5)):
        for method in ("window", "panes"):
            runs = []
            for i in range(4):
                t0 = time.perf_counter()
                fn(spark, sf, method=method).write.format("noop").mode("overwrite").save()
                if i:
                    runs.append(time.perf_counter() - t0)
            out[f"{name}[{method}]"] = round(statistics.median(runs), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
