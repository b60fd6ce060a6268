"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8).
Names given as arguments replace the headline list; ``all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from corpusloom import plans
from corpusloom.session import local_session

HEADLINE = [
    "tokenizer_corpus",
    "corpus_totals",
    "seeded_shuffle",
    "budget_shards",
    "ratio_mix",
    "insert_mix",
    "val_budget",
    "token_frequency",
    "bpe_train",
    "bpe_encode",
    "compression_ratio",
    "flat_token_rows",
    "bestfit_pack",
    "render_conversation",
    "render_tool_calls",
    "tool_call_parts",
    "tool_call_audit",
    "completion_match",
    "span_score",
    "core_metric",
    "pass_at_k",
    "bits_per_byte",
    "isoflop_fit",
    "step_metrics_extract",
    "debiased_ema",
    "report_metrics_pivot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(plans.QUERIES)
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # the first job of a session pays for its start
    seconds: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
