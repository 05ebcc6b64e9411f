"""Job wrapper: run one registered query over a table folder and write the
result as Parquet.

    python -m ludex.plans.run q45_recommend /data/tables /data/out/recommend

The output path must be a shared location on a cluster; nothing is written
anywhere else except checkpoints under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import sys
import time

from ludex.plans.queries import QUERIES
from ludex.session import get_session, release_checkpoints
from ludex.sources.sinks import write_parquet


def run(spark, name: str, sf_dir: str, out: str) -> float:
    t0 = time.time()
    write_parquet(QUERIES[name](spark, sf_dir), out)
    return time.time() - t0


def main(argv: list[str]) -> int:
    if len(argv) != 4 or argv[1] not in QUERIES:
        print(__doc__)
        print("queries:", " ".join(sorted(QUERIES)))
        return 2
    _, name, sf_dir, out = argv
    spark = get_session()
    try:
        secs = run(spark, name, sf_dir, out)
        print(f"{name}: wrote {out} in {secs:.2f} s")
    finally:
        release_checkpoints(spark)
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
