"""Jobs, tasks, longest task, records read and shuffled bytes per query: python tests/event_summary.py <event log>"""

from __future__ import annotations

import json
import sys
from collections import defaultdict


def summary(path: str) -> dict[str, dict[str, float]]:
    group_of: dict[int, str] = {}
    totals: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    with open(path) as lines:
        for line in lines:
            event = json.loads(line)
            kind = event["Event"]
            if kind == "SparkListenerJobStart":
                group = event.get("Properties", {}).get("spark.jobGroup.id", "")
                totals[group]["jobs"] += 1
                group_of.update({s: group for s in event["Stage IDs"]})
            elif kind == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                t, m = totals[group_of.get(event["Stage ID"], "")], event["Task Metrics"]
                t["tasks"] += 1
                t["records_read"] += m["Input Metrics"]["Records Read"]
                t["shuffle_bytes"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                t["longest_task_ms"] = max(t["longest_task_ms"], m["Executor Run Time"])
                t["task_ms"] += m["Executor Run Time"]
    return totals


if __name__ == "__main__":
    for name, t in summary(sys.argv[1]).items():
        print(f"{name:28s} " + " ".join(f"{k}={v:.0f}" for k, v in sorted(t.items())))
