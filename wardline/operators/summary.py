"""Verification summary of a final cohort (size, exposure and outcome shares)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cohort_summary(cohort: DataFrame, label: str, exposure: str = "statin_before_icu",
                   outcome: str = "sae_within_24h") -> DataFrame:
    """One row: rows, exposed count and share, outcome count and share.

    A single global aggregate: each task sums its partition, one row per
    task goes to the final step.
    """
    agg = cohort.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.sum(exposure).cast("bigint").alias("n_exposed"),
                     F.sum(outcome).cast("bigint").alias("n_outcome"))
    return agg.select(
        F.lit(label).alias("cohort"), "n_rows", "n_exposed",
        F.try_divide(F.col("n_exposed").cast("double"), F.col("n_rows").cast("double"))
         .alias("exposed_share"),
        "n_outcome",
        F.try_divide(F.col("n_outcome").cast("double"), F.col("n_rows").cast("double"))
         .alias("outcome_share"))
