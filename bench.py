"""Time the headline jobs and queries; prints one JSON line.

Every result is computed in full (a no-op sink takes all rows and columns). Each
entry runs once to warm up and three times for the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from isobar.operators.curate import curate  # noqa: E402
from isobar.plans import jobs, marts, metrics  # noqa: E402
from isobar.plans.hourly import QUESTIONS  # noqa: E402
from isobar.session import build_session  # noqa: E402
from isobar.sources.warehouse import Warehouse  # noqa: E402
from registry.inputs import event_samples, lake, lineitem_samples, readings  # noqa: E402

_RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median(run: Callable[[], object], runs: int = _RUNS) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", cores, cores)
    lk = lake(spark, sf_dir)
    hourly = lk.line_readings
    star, mart = lk.star, lk.mart
    feed = star.feed_named()
    newest = hourly.agg({"run_date": "max"}).first()[0]
    one_day = curate(hourly.where(hourly.run_date == newest))

    upserted = Warehouse(spark, lk.new_dir("bench-upsert"), "month")
    jobs.merge_star(upserted, curate(hourly))

    def reload() -> None:
        jobs.load_full(Warehouse(spark, lk.new_dir("bench-reload"), "month"), hourly)

    work: dict[str, Callable[[], object]] = {
        "readings_events": lambda: _consume(readings(event_samples(spark, sf_dir))),
        "readings_lineitem": lambda: _consume(readings(lineitem_samples(spark, sf_dir))),
        "curate": lambda: _consume(curate(hourly)),
        "star_reload": reload,
        "fact_upsert_one_day": lambda: jobs.merge_star(upserted, one_day),
        **{name: (lambda q=q: _consume(q(feed))) for name, q in QUESTIONS.items()},
        "mart_daily_summary": lambda: _consume(
            marts.daily_summary(star.fact, star.dates, star.locations)
        ),
        "metrics_by_location_weekend": lambda: _consume(
            metrics.metric_query(mart, metrics.METRICS, ["location_name", "is_weekend"])
        ),
    }
    seconds = {name: _median(run) for name, run in work.items()}
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "fact_rows": star.fact.count(),
        "cores": cores,
        "runs": _RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
