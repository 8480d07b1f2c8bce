"""Batch jobs: build both cohorts and write them (and optionally every stage).

The study writes each stage as a table; here the final cohorts are single
plans and stage tables are written only on request, clustered by the stay key or,
with ``--database``, bucketed by it in the catalog; what follows from a written
stage reads it.  Final tables are partitioned by the composite outcome, so an
outcome filter prunes files the way the study's outcome index serves lookups.
Every table is replaced in one step, and the counts of the summary are taken
while the cohorts are written.

    python -m wardline.plans.jobs --sf-dir /root/testdata/sf0.1 --out /shared/cohorts [--stages]
    python -m wardline.plans.jobs --parquet /shared/clinical --out /shared/cohorts
    python -m wardline.plans.jobs --csv /shared/clinical_csv --out /shared/cohorts
    python -m wardline.plans.jobs --catalog clinical --out /shared/cohorts
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline.operators import exposure as expo
from wardline.operators import outcome
from wardline.operators.joins import dropped_stages
from wardline.plans import offset as off
from wardline.plans import timestamped as tsp
from wardline.sizes import exact_rows
from wardline.sources.adapter import sources
from wardline.sources.bucketed import BucketedStages
from wardline.sources.tables import write_table


def stage_tables(src, b: DataFrame, ob: DataFrame) -> dict[str, DataFrame]:
    """Stages of both models that are made from the sources (bases given), by table name."""
    return {
        "timestamped_base": b,
        "timestamped_eligibility": tsp.eligibility_stage(src, b),
        "timestamped_gcs_firstday": tsp.gcs_stage(src, b),
        "timestamped_delirium_features": tsp.delirium_features_stage(src, b),
        "timestamped_statins": tsp.statins_stage(src, b),
        "timestamped_mortality": tsp.mortality_stage(b),
        "offset_base": ob,
        "offset_sepsis": off.sepsis_stage(src, ob),
        "offset_eligibility": off.eligibility_stage(src, ob),
        "offset_gcs_firstday": off.gcs_stage(src),
        "offset_delirium_firstday": off.delirium_stage(src),
        "offset_exposure": off.exposure_stage(src, ob),
    }


# Stages with any number of rows a stay, and the column that tells those of a stay apart.
MANY = {"timestamped_delirium_features": "charttime", "timestamped_statins": "starttime"}


def _key(name: str) -> str:
    return "stay_id" if name.startswith("timestamped") else off.KEY


def derived_tables(b: DataFrame, read) -> dict[str, DataFrame]:
    """Stages made from stage tables that are written already (``read(name)``)."""
    drugs = read("timestamped_statins").join(b.select("stay_id", "icu_intime"), "stay_id")
    return {
        "timestamped_delirium_status": outcome.rule_status(b, read("timestamped_delirium_features")),
        "timestamped_exposure": expo.exposure_flags(b, drugs),
    }


def written_stages(read) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The stages that each final cohort joins, read back from where they were written."""
    ts = {"eligibility": "eligibility", "gcs": "gcs_firstday", "delirium": "delirium_status", "exposure": "exposure"}
    of = {"sepsis": "sepsis", "eligibility": "eligibility", "gcs": "gcs_firstday", "delirium": "delirium_firstday", "exposure": "exposure"}
    return ({k: read(f"timestamped_{v}") for k, v in ts.items()}, {k: read(f"offset_{v}") for k, v in of.items()})


def observed(cohort: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """A final cohort whose counts are taken while it is written.

    They are taken above every exchange, in the stage that writes, where a task
    counts once however often it runs.
    """
    seen = Observation(label)
    one = lambda name: F.sum(F.when(F.col(name) == 1, 1).otherwise(0)).cast("bigint")
    return cohort.observe(seen, F.count(F.lit(1)).alias("n_rows"), one("statin_before_icu").alias("n_exposed"),
                          one("sae_within_24h").alias("n_outcome")), seen


def summary_rows(spark: SparkSession, seen: dict[str, Observation], bases: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """The verification summary and the attrition (base, eligible, exposed, outcome) from counts already taken."""
    rows = {label: o.get for label, o in seen.items()}
    share = lambda n, of: n / of if of else None
    summary = spark.createDataFrame(
        [(label, r["n_rows"], r["n_exposed"] or 0, share(r["n_exposed"] or 0, r["n_rows"]), r["n_outcome"] or 0,
          share(r["n_outcome"] or 0, r["n_rows"])) for label, r in rows.items()],
        "cohort string, n_rows long, n_exposed long, exposed_share double, n_outcome long, outcome_share double")
    steps = spark.createDataFrame(
        [(label, i, step, n) for label, r in rows.items() for i, (step, n) in enumerate(
            [("base", bases[label]), ("eligible", r["n_rows"]), ("exposed", r["n_exposed"] or 0), ("outcome", r["n_outcome"] or 0)])],
        "cohort string, place int, step string, n long")
    return summary, steps


def build(spark: SparkSession, sf_dir: str | None, out_dir: str, with_stages: bool = False,
          src=None, database: str | None = None) -> dict:
    """Write both final cohorts (and, with ``with_stages``, every stage table).

    ``src`` is any source map (stored tables); without it the driver tables
    of ``sf_dir`` are adapted.  ``database`` names a catalog database that
    takes the stages as tables bucketed by their key, which the final joins
    then read without an exchange; else they are written below ``out_dir``.
    Returns the folder (or catalog name) of every table.  Intermediate stages are
    removed when the job ends.
    """
    with dropped_stages(spark):
        return _build(spark, sf_dir, out_dir, with_stages, src, database)


def _build(spark: SparkSession, sf_dir: str | None, out_dir: str, with_stages: bool, src, database: str | None) -> dict:
    src = src if src is not None else sources(spark, sf_dir)
    b, ob = tsp.base_cohort(src), off.base_cohort(src)      # each materialised and counted once
    written, stored = {}, None
    store = BucketedStages(spark, database) if database else None

    def read(name: str) -> DataFrame:
        return store.read(name) if store else spark.read.parquet(written[name])

    def write(name: str, df: DataFrame) -> None:
        if store:
            store.write(name, df, _key(name), many=name in MANY)
            written[name] = f"{database}.{name}"
        else:
            columns = [_key(name), *([MANY[name]] if name in MANY else [])]
            written[name] = write_table(df, os.path.join(out_dir, name), cluster_by=columns)

    if with_stages or store:
        for name, df in stage_tables(src, b, ob).items():
            write(name, df)
        for name, df in derived_tables(b, read).items():
            write(name, df)
        stored = written_stages(read)
    ts_base, off_base = (read("timestamped_base"), read("offset_base")) if store else (b, ob)
    finals = {"timestamped": tsp.cohort(src, base=ts_base, written=stored and stored[0]),
              "offset": off.cohort(src, base=off_base, written=stored and stored[1])}
    seen = {}
    for label, df in finals.items():
        name = f"{label}_final_cohort"
        df, seen[label] = observed(df, label)
        written[name] = write_table(df, os.path.join(out_dir, name), partition_by="sae_within_24h")
    summary, steps = summary_rows(spark, seen, {"timestamped": exact_rows(b), "offset": exact_rows(ob)})
    for name, df in (("cohort_summary", summary), ("cohort_attrition", steps)):
        written[name] = write_table(df.coalesce(1), os.path.join(out_dir, name))
    return written


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    given = ap.add_mutually_exclusive_group(required=True)
    given.add_argument("--sf-dir", help="driver tables, adapted to clinical shapes")
    given.add_argument("--parquet", help="folder of clinical tables as parquet")
    given.add_argument("--csv", help="folder of clinical tables as CSV with header")
    given.add_argument("--catalog", help="catalog database holding the clinical tables")
    ap.add_argument("--out", required=True)
    ap.add_argument("--stages", action="store_true", help="also write every stage table")
    ap.add_argument("--database", help="catalog database for stage tables bucketed by stay")
    args = ap.parse_args(argv)
    spark = SparkSession.getActiveSession()
    if spark is None:
        from wardline.session import build_session
        spark = build_session()
    from wardline.sources import tables
    src = (tables.parquet_sources(spark, args.parquet, conform=True) if args.parquet else
           tables.csv_sources(spark, args.csv) if args.csv else
           tables.catalog_sources(spark, args.catalog, conform=True) if args.catalog else None)
    for name, path in build(spark, args.sf_dir, args.out, args.stages, src=src, database=args.database).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
