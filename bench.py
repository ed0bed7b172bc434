"""Time the registered queries: python bench.py [name prefix ...]

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the input
and the cores. Every query runs once after one warm-up query; the whole result is
computed and thrown away by the ``noop`` sink. Prints one JSON line.
"""

import json
import os
import sys
import time

from millrace.plans import all_queries
from millrace.session import local_session


def main():
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    found = all_queries()
    wanted = sys.argv[1:]
    run = lambda name: found[name].build(spark, directory).write.format("noop").mode("overwrite").save()
    run("t06_enrich_inner")
    seconds = {}
    for name in found:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        run(name)
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
