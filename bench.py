"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from rentlens.plans.catalogue import QUERIES  # noqa: E402
from rentlens.plans.fixtures import Tables  # noqa: E402
from rentlens.plans.study import Study  # noqa: E402

# one or two per operator group
NAMES = ["src_listings", "clean_listings", "fee_median_stratum", "exclusion_counts", "listing_counts",
         "cohort_keep", "cohort_summary_median", "impute_rent", "ratio_split", "rejected_rows", "pool_neighbor",
         "pool_assign", "pool_moments", "t2_statistic_p3", "chart_points", "ols_normal_equations", "prune",
         "lmm_profile_p1", "diag_boxplot", "diag_boxplot_narrowed", "rates_sector", "val_errors",
         "val_summary_grouping_sets", "second_sample_union"]


def run(df: DataFrame) -> None:
    """Compute every row and column without collecting them."""
    df.write.mode("overwrite").format("noop").save()


def steps(spark: SparkSession, folder: str) -> dict[str, float]:
    """The study from listings to rates, timed step by step; every step starts from stored tables."""
    t = Tables(spark, folder)
    study = Study(t.listings, t.fee_census, t.cadastral)
    parts = {"study_clean": lambda: study.cleaned, "study_quality_control": lambda: study.kept,
             "study_cohorts": lambda: study.split,
             "study_models": lambda: [c.fits for c in study.classes.values()],
             "study_rates": lambda: (run(study.sector_rates), run(study.locality_rates))}
    out = {}
    for name, step in parts.items():
        start = time.perf_counter()
        step()
        out[name] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["clean_exclusions"](spark, folder))  # start-up of the JVM is not measured
    times = {}
    for name in NAMES:
        start = time.perf_counter()
        run(QUERIES[name](spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    times.update(steps(spark, folder))
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0)}))


if __name__ == "__main__":
    main()
