"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Stages the adapter views once (reported as ``stage_sec``; this is the
one-off derivation of the annotation tables from the test tables, which a
real deployment reads as existing tables), then runs each headline query to
completion with the ``noop`` sink (full execution, nothing collected) and
records the best of two runs after one untimed warm-up pass.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dataclass_gene",            # T20 flagship mart
    "gene_allele",               # T14 four-branch union
    "gene_insertion_overlaps",   # J13 interval join
    "class_counts",              # R1 pivot
    "gene_summary_stats",        # R2 five per-gene counts
    "update_ids",                # U1 id validation
    "gene_alleles_v1",           # T2+T3 allele mart with counters
    "pathway_members",           # T16 nine enrichments
    "overlapping_transcripts",   # R9 slice + names
    "go_counts",                 # R10 pivoted distinct counts
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from annomart.queries import QUERIES, cat
    from annomart.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app="annomart-bench")
    t0 = time.time()
    c = cat(spark, sf_dir)
    c.stage_all(workers=4)
    stage = time.time() - t0

    # warm-up: one untimed pass over the headline queries (JIT, codegen,
    # file listings), so timings do not depend on whether staging just ran
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):
            # keep the opened tables and resolved vocabulary, but rebuild the
            # derived marts (symbols, allele rows) inside the timing
            for k in [k for k in c._cache if isinstance(k, str) and k.startswith("derived:")]:
                del c._cache[k]
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            d = time.time() - t
            best = d if best is None else min(best, d)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "stage_sec": round(stage, 3),
                      "cpus": cpus, "spark": spark.version}))


if __name__ == "__main__":
    main()
