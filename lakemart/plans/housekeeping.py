"""Run log, clean-up of the stage layer, and removal of orphaned test results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx
from lakemart.operators import runlog
from lakemart.sinks.versions import Tables

RUNS, COMPLETED = "log_runs", "log_completed"


def note_run(tables: Tables, done: list[str], at: datetime) -> DataFrame:
    """Note the start of every stage load of a run, and as completed those
    whose history load has followed.  Returns the completed loads."""
    spark, now = tables.spark, F.lit(at).cast("timestamp")
    stages = [name for name in done if name.startswith("stg_")]
    finished = [name for name in stages if name.replace("stg_", "dw_", 1) in done]
    runs = tables.read(RUNS) if tables.exists(RUNS) else runlog.empty_runs(spark)
    completed = tables.read(COMPLETED) if tables.exists(COMPLETED) else runlog.empty_completed(spark)
    runs = tables.write(RUNS, runlog.start(runs, stages, now))
    return tables.write(COMPLETED, runlog.complete(completed, runs, finished))


def release(tables: Tables, raw_table: str) -> None:
    """Allow the clean-up of a table."""
    chosen = F.col("raw_table") == raw_table
    tables.write(COMPLETED, tables.read(COMPLETED).withColumn("execute", F.col("execute") | chosen))


def clean(tables: Tables) -> list[str]:
    """Drop stage rows copied before the last completed load, for released
    tables only."""
    completed = tables.read(COMPLETED)
    released = sorted(r.raw_table for r in completed.filter("execute").collect())
    for raw_table in released:
        name = f"stg_{raw_table}"
        tables.write(name, runlog.retain(tables.read(name), completed, raw_table))
    return released


def without_orphans(results: DataFrame, criteria: DataFrame) -> DataFrame:
    """Selection results whose queue the criteria of the target still list."""
    phases = jsonx.records("valinnanvaiheet", "valintatapajono array<struct<oid: string>>")
    queues = criteria.select("hakukohde_oid", F.explode(phases).alias("p")).select(
        "hakukohde_oid", F.explode("p.valintatapajono.oid").alias("valintatapajono_oid")
    )
    return results.join(queues, ["hakukohde_oid", "valintatapajono_oid"], "left_semi")
