"""Jobs, tasks and bytes of the headline queries, from Spark's event log: python tools/measure.py [sf_dir] [query ...]"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bench import HEADLINE  # noqa: E402
from plumbline.session import builder  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or HEADLINE
    log = tempfile.mkdtemp(prefix="events-")
    spark = (
        builder("measure")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log)
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        spark.sparkContext.setLocalProperty("measure.query", name)
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = time.perf_counter() - start
    spark.stop()

    totals = {name: dict.fromkeys(("jobs", "tasks", "shuffle", "spill", "cpu"), 0) for name in names}
    stage_query = {}
    for line in next(Path(log).iterdir()).open(encoding="utf-8"):
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            name = (event.get("Properties") or {}).get("measure.query")
            if name in totals:
                totals[name]["jobs"] += 1
                stage_query.update(dict.fromkeys(event["Stage IDs"], name))
        elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in stage_query:
            t, m = totals[stage_query[event["Stage ID"]]], event.get("Task Metrics") or {}
            t["tasks"] += 1
            t["shuffle"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            t["spill"] += m.get("Disk Bytes Spilled", 0)
            t["cpu"] += m.get("Executor CPU Time", 0)
    print("| Query | s (first run) | jobs | tasks | task CPU s | shuffle KB | spilled KB |")
    print("| --- | ---: | ---: | ---: | ---: | ---: | ---: |")
    for name, t in totals.items():
        print(
            f"| `{name}` | {seconds[name]:.2f} | {t['jobs']} | {t['tasks']} | {t['cpu'] / 1e9:.2f} | "
            f"{t['shuffle'] // 1024} | {t['spill'] // 1024} |"
        )


if __name__ == "__main__":
    main()
