"""Stage a corpus of bag directories: write the staged set (K01) and the outcome
log (K02).

    python scripts/stage_corpus.py ROOT SETTINGS_PARQUET DISCIPLINES_PARQUET \\
        LICENSES_PROPERTIES LICENSE_DIR OUT_DIR [--run-id ID] [--remark-date ISO]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    for a in ["root", "settings", "disciplines", "license_properties", "license_dir", "out"]:
        ap.add_argument(a)
    ap.add_argument("--run-id", default="1", help="a run that is repeated under its id replaces its log")
    ap.add_argument("--remark-date", default="1970-01-01T00:00:00.000Z")
    a = ap.parse_args()

    from pyspark.sql import SparkSession

    from bagyard.plans import dataset_job as DJ
    from bagyard.plans.corpus import corpus_inputs
    from bagyard.session import configure, intermediate_tables
    from bagyard.sources import scans, sinks

    spark = SparkSession.builder.getOrCreate()
    configure(spark, cluster=not spark.sparkContext.master.startswith("local["))
    with intermediate_tables(spark):
        inp = corpus_inputs(spark, a.root, spark.read.parquet(a.settings), spark.read.parquet(a.disciplines),
                            scans.license_catalog(spark, a.license_properties, a.license_dir))
        res = DJ.stage_datasets(inp)
        sinks.write_staged_set(res.tables(a.remark_date), f"{a.out}/staged", inp.deposits)
        sinks.write_outcome(inp.deposits, res.rejects, f"{a.out}/log", a.run_id)


if __name__ == "__main__":
    main()
