"""Time the headline queries; prints one JSON line.

``python bench.py [name prefix …]`` times others, ``python bench.py all`` every
registered query. Each runs once to warm up and then ``BENCH_RUNS`` times
(default 3); the median counts. Results go to the ``noop`` sink, so all rows
are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "e7_", "a1_accuracy", "a2_", "a3_", "f6_", "t1_", "t3_", "t12_", "t13_", "t14_parse", "t15_",
    "j1_", "j2_", "j3_", "k1_", "q", "s1_", "s2_", "s9_markdown_answers", "s10_turtle_answers",
    "s11_", "m",
)


def main() -> None:
    from pollwright.plans import catalogue
    from pollwright.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    asked = tuple(sys.argv[1:]) or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")

    times: dict[str, float] = {}
    for name, run in catalogue.queries().items():
        if asked != ("all",) and not name.startswith(asked):
            continue
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 4)
        print(f"{name} {times[name]:.3f}", file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
