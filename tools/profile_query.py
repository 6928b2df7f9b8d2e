"""Time named queries (second run) at a scale factor: python tools/profile_query.py SF_DIR name..."""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kaiji.plans import registry  # noqa: E402
from kaiji.session import build_session  # noqa: E402

spark = build_session("local[8]", shuffle_partitions=16)
spark.sparkContext.setLogLevel("ERROR")
qs = registry.queries()
for name in sys.argv[2:]:
    for i in range(2):
        t = time.perf_counter()
        qs[name](spark, sys.argv[1]).write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t
    print(f"PROFILE {name} {dt:.2f}s", flush=True)
    if os.environ.get("EXPLAIN"):
        qs[name](spark, sys.argv[1]).explain("formatted")
