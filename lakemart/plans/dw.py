"""History layer: one row per object and change time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from lakemart.functions.keys import surrogate_key
from lakemart.operators import history, latest
from lakemart.operators.history import FIRST_SEEN
from lakemart.plans.model import Since, add, model
from lakemart.plans.shapes import SHAPES

STORED = "dw_metadata_dw_stored_at"
STAGED = "dw_metadata_stg_stored_at"

# table -> merge keys
KEYS = {
    "hakukohderyhmapalvelu_ryhma": ("oid", "muokattu"),
    "ohjausparametrit_parameter": ("haku_oid", "muokattu"),
    "sure_arvosana": ("resourceid", "muokattu"),
    "sure_ensikertalainen": ("hakuoid", "henkilooid"),
    "sure_harkinnanvaraisuus": ("hakemusoid",),
    "sure_opiskelija": ("resourceid", "muokattu"),
    "sure_opiskeluoikeus": ("resourceid", "muokattu"),
    "sure_proxysuoritus": ("hakemusoid",),
    "sure_suoritus": ("resourceid", "muokattu"),
    "valintalaskenta_pistetieto": ("valintakoe_hakemus_id", "muokattu"),
    "valintalaskenta_valintakoe_osallistuminen": ("hakemusoid", "muokattu"),
    "valintaperusteet_avain": ("hakukohde_oid", "muokattu"),
    "valintaperusteet_hakukohde": ("hakukohde_oid", "muokattu"),
    "valintarekisteri_hyvaksyttyjulkaistuhakutoive": ("hakukohde_henkilo_id", "muokattu"),
    "valintarekisteri_ilmoittautuminen": ("ilmoittautuminen_id", "muokattu"),
    "valintarekisteri_lukuvuosimaksu": ("hakukohde_henkilo_id", "muokattu"),
    "valintarekisteri_valinnantulos": ("valinnantulos_id", "muokattu"),
    "valintarekisteri_valintatapajono": ("valintatapajono_id",),
    "valintarekisteri_vastaanotto": ("hakukohde_henkilo_id", "muokattu"),
    "kouta_ammattinimike": ("kieli", "arvo"),
    "kouta_asiasana": ("kieli", "arvo"),
    "kouta_haku": ("oid", "muokattu"),
    "kouta_hakukohde": ("oid", "muokattu"),
    "kouta_koulutus": ("oid", "muokattu"),
    "kouta_oppilaitoksetjaosat": ("oid", "muokattu"),
    "kouta_pistehistoria": ("id", "muokattu"),
    "kouta_sorakuvaus": ("id", "muokattu"),
    "kouta_toteutus": ("oid", "muokattu"),
    "kouta_valintaperuste": ("id", "muokattu"),
    "koutalight_koulutus": ("koulutus_id", "muokattu"),
    "supa_ensikertalainen": ("hakemus_oid",),
    "supa_harkinnanvaraisuus": ("hakemus_oid",),
    "supa_valintadata": ("hakemus_oid",),
    "onr_yhteystieto": ("yhteystieto_id",),
    "organisaatio_organisaatio": ("organisaatio_oid", "muokattu"),
    "organisaatio_organisaatiosuhde": ("suhde_id",),
    "organisaatio_osoite": ("organisaatioosoite_id",),
    "organisaatio_ryhma": ("oid",),
}


# tables whose rows are looked up next by a column that their key is made of
TOGETHER = {"valintarekisteri_valintatapajono": "oid"}


def _merged(table: str, keys: tuple[str, ...]):
    # versions of an object: its newest one is picked next
    together = TOGETHER.get(table) or (keys[0] if len(keys) == 2 and keys[1] == "muokattu" else None)
    made = SHAPES[table].key if table in SHAPES else None
    digest = made if made and made[0] == keys[0] else None

    def build(stage: DataFrame, now: Column) -> DataFrame:
        return history.one_copy(stage, list(keys), together, digest).withColumn(STORED, now)

    return build


def _digests(table: str) -> tuple:
    return (SHAPES[table].key,) if table in SHAPES and SHAPES[table].key else ()


for _name, _keys in KEYS.items():
    add(
        f"dw_{_name}", _merged(_name, _keys), (f"stg_{_name}", "now"),
        load="merge", keys=_keys, keep=tuple(FIRST_SEEN), since=Since(STAGED, or_null=True), history=True,
        by_month="muokattu" if "muokattu" in _keys else None, digests=_digests(_name),
    )


@model(
    load="merge", keys=("hakemus_versio_id", "muokattu"), history=True, since=Since("dw_metadata_dbt_copied_at"),
    by_month="muokattu", digests=_digests("ataru_hakemus"),
    keep=("dw_metadata_stg_stored_at", *[c for c in FIRST_SEEN if c != "dw_metadata_source_timestamp_at"]),
)
def dw_ataru_hakemus(stg_ataru_hakemus: DataFrame, now: Column) -> DataFrame:
    # a version belongs to one application, whose newest version is picked next
    return history.one_copy(stg_ataru_hakemus, ["hakemus_versio_id", "muokattu"], "oid", SHAPES["ataru_hakemus"].key).withColumn(STORED, now)


@model(load="merge", keys=("lomake_id_versioid_id",), history=True, since=Since(STAGED))
def dw_ataru_lomake(stg_ataru_lomake: DataFrame, now: Column) -> DataFrame:
    """Merged on the form version alone, so of several change times in one
    load the newest is kept."""
    newest = latest.newest_per_key(stg_ataru_lomake, ["lomake_id_versioid_id"], "muokattu", "dw_metadata_dbt_copied_at")
    return newest.withColumn(STORED, now)


@model(load="merge", keys=("valinnanvaihe_id",), newer="muokattu", history=True)
def dw_valintalaskenta_valintalaskennan_tulos(stg_valintalaskenta_valintalaskennan_tulos: DataFrame, now: Column):
    newest = latest.newest_with_ties(stg_valintalaskenta_valintalaskennan_tulos, ["valinnanvaihe_id"], "muokattu")
    return current(newest, "valinnanvaihe_id").withColumn(STORED, now)


@model(load="merge", keys=("jonosija_id",), since=Since(STAGED), history=True)
def dw_valintarekisteri_jonosija(stg_valintarekisteri_jonosija: DataFrame, int_sijoitteluajo: DataFrame, now: Column):
    """Places of the latest allocation run of each queue only."""
    run = int_sijoitteluajo.select("valintatapajono_oid", "sijoitteluajo_id")
    # digests do not compress, so the shuffles carry the columns that they are made of
    name, parts = SHAPES["valintarekisteri_jonosija"].key
    of_run = stg_valintarekisteri_jonosija.drop(name).join(run, ["valintatapajono_oid", "sijoitteluajo_id"], "left_semi")
    places = of_run.repartition(surrogate_key(*parts)).withColumn(name, surrogate_key(*parts))
    return current(places, name).select(*stg_valintarekisteri_jonosija.columns).withColumn(STORED, now)


@model(load="replace_changed", keys=("henkilo_oid",), since=Since(STAGED), history=True)
def dw_supa_opiskeluoikeus(stg_supa_opiskeluoikeus: DataFrame, now: Column) -> DataFrame:
    return current(stg_supa_opiskeluoikeus, "henkilo_oid", by="aikaleima").withColumn(STORED, now)


@model(load="merge", keys=("henkilo_oid",), keep=(STORED,), history=True)
def dw_onr_henkilo(stg_onr_henkilo: DataFrame, now: Column) -> DataFrame:
    return current(stg_onr_henkilo, "henkilo_oid").withColumn(STORED, now)


@model()
def dw_koodisto_koodi(stg_koodisto_koodi: DataFrame, now: Column) -> DataFrame:
    return stg_koodisto_koodi.withColumn(STORED, now)


@model()
def dw_koodisto_relaatio(stg_koodisto_relaatio: DataFrame, now: Column) -> DataFrame:
    return stg_koodisto_relaatio.withColumn(STORED, now)


def current(history_rows: DataFrame, *keys: str, by: str = "muokattu") -> DataFrame:
    """Newest row per key; equal times are decided by the delivery."""
    decide = [
        c
        for c in ("dw_metadata_dbt_copied_at", "dw_metadata_filename", "dw_metadata_file_row_number")
        if c in history_rows.columns
    ]
    return latest.newest_per_key(history_rows, list(keys), by, *decide)
