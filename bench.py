"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and run to completion once with the no-op sink (every
row is computed, nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q19_ratings",              # lag, transitions, item means, ladder
    "q11_iqr_bounds",           # exact quantiles
    "q35_cosine_pairs",         # co-rated cosine (behaviour log)
    "q35b_cosine_pairs_basket",  # the same on the basket: ~12.7 M pairs at sf0.1
    "q40_damped_pearson",       # centred similarity, two modes
    "q38_cosine_rmse",          # cosine model: train + score + RMSE
    "q43_pearson_rmse",         # Pearson model: train + score + RMSE
    "q27_als_rmse",             # ALS model on the basket: encode + fit + predict + RMSE
    "q47_als_rmse_log",         # ALS on the log and split of the KNN models
    "q45_recommend",            # flagship: top-5 unseen items per user
]


# RMSE reported next to the timings, all three on the behaviour log and one
# split: query -> model (rows of mode ``user`` where there are modes).
RMSE_QUERIES = {"q47_als_rmse_log": "als", "q38_cosine_rmse": "cosine",
                "q43_pearson_rmse": "pearson"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ludex.plans.queries import QUERIES
    from ludex.session import get_session, release_checkpoints

    spark = get_session(f"local[{cpus}]", max(cpus, 8), app_name="ludex-bench",
                        extra={"spark.driver.memory": "16g",
                               "spark.checkpoint.dir": "/tmp/checkpoints/bench"})
    # Warm-up on the smallest fixture (JVM start, class loading, JIT of the
    # common operators); timed runs below use the full $BENCH_SF_DIR tables.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["q45_recommend"](spark, warm).write.format("noop").mode("overwrite").save()

    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    rmse: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        if name in RMSE_QUERIES:
            # Results of one or two rows: collecting them is the full action.
            for row in df.collect():
                if "mode" not in df.columns or row["mode"] == "user":
                    rmse[RMSE_QUERIES[name]] = row["rmse"]
        else:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "rmse": rmse,
        "cpus": cpus,
    }))
    release_checkpoints(spark)
    spark.stop()


if __name__ == "__main__":
    main()
