"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import waveforms
from colloquy.params import TrackParams
from colloquy.plans import catalog
from colloquy.plans.tracks import plan
from colloquy.sources import adapters

HEADLINE = (
    "src_utterances", "spec_tracks", "pool_build", "pat_all", "plan_timeline", "plan_events", "track_rows", "track_summary",
    "agg_speaker_index", "val_report", "dsp_snr_mix", "noise_pink", "track_waveforms", "dataset_written",
    "snk_parquet_roundtrip", "str_incremental",
)


def waveforms_16khz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-length 16 kHz tracks from two-second utterances, one per conversation."""
    params = TrackParams()
    source = adapters.embedding_waves(spark, sf_dir, repeat=500)
    requests = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").alias("track_id")).distinct()
    return waveforms.build_waveforms(plan(source, requests, params).turns, source, params)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("colloquy-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="colloquy-bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    chosen = {name: queries[name] for name in HEADLINE} | {"waveforms_16khz": waveforms_16khz}
    wanted = sys.argv[1:] or list(chosen)
    queries["plan_timeline"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in wanted:
        started = time.time()
        chosen[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 2)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 2), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
