"""Stage layer: raw documents to typed columns, appended per load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.plans.model import Since, add
from lakemart.plans.shapes import SHAPES
from lakemart.sources.landing import empty_raw
from lakemart.sources.shred import Shape, shred

# replaced as a whole by every load of their source
SNAPSHOTS = ("koodisto_koodi", "koodisto_relaatio")
# every load reads the whole raw table again
ALWAYS_WHOLE = ("valintarekisteri_lukuvuosimaksu",)
# sources that are no longer delivered
DISABLED = ("valintapiste_service_pistetieto",)


def _builder(shape: Shape):
    def build(raw: DataFrame, now: Column) -> DataFrame:
        return shred(raw, shape, now)

    return build


def _load(raw: str) -> dict:
    if raw in SNAPSHOTS:
        return {"load": "table"}
    if raw in ALWAYS_WHOLE:
        return {"load": "append"}
    return {"load": "append", "since": Since("dw_metadata_dbt_copied_at")}


class PersonSince(Since):
    """Persons are dated by their own change time; a week is read again."""

    def apply(self, df: DataFrame, newest) -> DataFrame:
        changed = df.withColumn("_updated", F.get_json_object("data", "$.updated").cast("timestamp"))
        return Since("_updated", "muokattu", overlap="7 DAYS").apply(changed, newest).drop("_updated")


for _raw, _shape in SHAPES.items():
    if _raw not in DISABLED:
        _options = _load(_raw)
        if _raw == "onr_henkilo":
            _options["since"] = PersonSince()
        add(f"stg_{_raw}", _builder(_shape), (_raw, "now"), **_options)


def raw_defaults(spark: SparkSession, name: str) -> DataFrame:
    """Raw tables and seeds before any delivery."""
    from lakemart.plans.seeds import SEEDS

    return SEEDS[name](spark) if name in SEEDS else empty_raw(spark)


def raw_tables() -> list[str]:
    """Names of the raw tables that the stage layer reads."""
    return sorted(r for r in SHAPES if r not in DISABLED)
