"""Time the headline queries on whole tables and print one JSON line.

Prepared tables are made afresh in every run, as lines of their own (``prepare_*``), before the queries that read them.
"""

from __future__ import annotations

import json
import os
import time

from sftframe.catalog import inputs
from sftframe.catalog.queries import QUERIES
from sftframe.catalog.session import local_session

#: Prepared tables in the order in which they need each other.
PREPARED = ("kept_pairs", "vocab", "prepared", "split_rows", "numbered", "merges", "prefs", "unigrams", "steps")
HEADLINE = (
    "context_filter_docs",
    "token_counts",
    "vocab_top",
    "prompt_length",
    "encode_ids",
    "encode_ids_joined",
    "decode_text",
    "bpe_encode",
    "bpe_decode",
    "epoch_plan",
    "epoch_order",
    "shard_resume",
    "collate_masked",
    "collate_batches",
    "pref_pairs",
    "pref_sequences",
    "pref_truncate_end",
    "pref_packed",
    "dpo_regul",
    "dpo_metrics",
    "label_logp",
    "dpo_weighted",
    "topk_softmax",
    "sampled",
    "compare_responses",
    "generate_bigram",
    "run_steps",
    "run_windows",
    "stream_prepare",
    "stream_windows",
    "stream_windows_live",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in PREPARED:
        started = time.perf_counter()
        getattr(inputs, name)(spark, sf_dir)
        seconds[f"prepare_{name}"] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
