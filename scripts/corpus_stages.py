"""Stage runner mirroring the reference's commands: collect -> chunk -> sft -> text.

    python scripts/corpus_stages.py --sf /root/testdata/sf0.001 --out /path/to/stages [stage ...]

Each stage reads the previous stage's Parquet output and writes its own (counts are
gathered while writing, via ``observe``). Inputs come from the driver tables through
the adapter views; on real data the same operators read landed responses.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

STAGES = ["collect", "chunk", "sft", "text"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("--out", required=True)
    ap.add_argument("stages", nargs="*", default=STAGES)
    a = ap.parse_args()
    from quarry.operators import chunks as ch
    from quarry.operators import collect as co
    from quarry.operators import sft
    from quarry.operators.core import exact_hash_split
    from quarry.session import get_session
    from quarry.sources import io
    from quarry.sources.fixtures import fixture

    spark = get_session()
    out = a.out.rstrip("/")
    report = {}
    for stage in a.stages:
        if stage == "collect":
            samples, failed = co.collect_samples(fixture(spark, a.sf, "v_readme_samples"),
                                                 fixture(spark, a.sf, "v_repo_trees"), min_length=500)
            report["collect"] = io.write_with_counts(samples, f"{out}/samples", fmt="parquet")
            report["collect_failed"] = io.write_with_counts(failed.select("repo_url", "owner", "repo"), f"{out}/failed",
                                                            fmt="parquet")
        elif stage == "chunk":
            samples = spark.read.parquet(f"{out}/samples")
            report["chunk"] = io.write_with_counts(ch.chunk_features(samples), f"{out}/chunks", fmt="parquet")
        elif stage == "sft":
            chunks = spark.read.parquet(f"{out}/chunks")
            samples = sft.build_sft_samples(chunks)
            split = exact_hash_split(samples, key=F.concat_ws("#", "repo_url", F.col("chunk_no").cast("string")),
                                     fraction=0.9, seed=42)
            report["sft"] = io.write_with_counts(split, f"{out}/sft", fmt="parquet",
                                                 metrics={"train": F.count_if("is_train")})
        elif stage == "text":
            s = spark.read.parquet(f"{out}/sft").filter("is_train").drop("is_train")
            texts = sft.alpaca_text(s)
            split = exact_hash_split(texts, key=F.concat_ws("#", "repo_url", F.col("chunk_no").cast("string")),
                                     fraction=0.95, seed=7)
            report["text"] = io.write_with_counts(split.select("repo_url", "chunk_no", "text", "is_train"),
                                                  f"{out}/text", fmt="parquet", metrics={"train": F.count_if("is_train")})
        else:
            raise SystemExit(f"unknown stage {stage}; choose from {STAGES}")
    print(json.dumps(report))


if __name__ == "__main__":
    main()
