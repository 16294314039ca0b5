"""First integration layer: the current state of each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx, seasons, text
from lakemart.functions.keys import surrogate_key
from lakemart.operators import latest, merge
from lakemart.plans.dw import current
from lakemart.plans.model import Since, add, model

STORED = "dw_metadata_dw_stored_at"
STAGED = "dw_metadata_stg_stored_at"
METADATA = (
    "dw_metadata_source_timestamp_at",
    "dw_metadata_stg_stored_at",
    "dw_metadata_dbt_copied_at",
    "dw_metadata_filename",
    "dw_metadata_file_row_number",
    "dw_metadata_dw_stored_at",
)

# tables whose current state is the newest history row per key, as it is
PLAIN_CURRENT = {
    "organisaatio_organisaatio": "organisaatio_oid",
    "hakukohderyhmapalvelu_ryhma": "oid",
    "valintaperusteet_hakukohde": "hakukohde_oid",
    "kouta_oppilaitoksetjaosat": "oid",
    "kouta_pistehistoria": "id",
    "kouta_sorakuvaus": "id",
}
# tables without versions
COPIES = ("koodisto_relaatio", "kouta_ammattinimike", "kouta_asiasana", "sure_proxysuoritus")


def _newest(key: str):
    return lambda rows: current(rows, key)


for _name, _key in PLAIN_CURRENT.items():
    add(f"int_{_name}", _newest(_key), (f"dw_{_name}",))
for _name in COPIES:
    add(f"int_{_name}", lambda rows: rows, (f"dw_{_name}",))


def choice_key() -> Column:
    return surrogate_key("hakemus_oid", "hakukohde_oid").alias("hakutoive_id")


def target_person_key() -> Column:
    return surrogate_key("hakukohde_oid", "henkilo_oid").alias("hakukohde_henkilo_id")


def queue_key() -> Column:
    return surrogate_key("hakemus_oid", "hakukohde_oid", "valintatapajono_oid").alias("hakemus_hakukohde_valintatapa_id")


# --- applications ---

# answers with the year in which an earlier education was completed (fixed values)
COMPLETION_QUESTIONS = """
    other-eligibility-year-of-completion
    pohjakoulutus_amp--year-of-completion
    pohjakoulutus_amt--year-of-completion
    pohjakoulutus_amv--year-of-completion
    pohjakoulutus_am--year-of-completion
    pohjakoulutus_avoin--year-of-completion
    pohjakoulutus_kk_ulk--year-of-completion
    pohjakoulutus_lk--year-of-completion
    pohjakoulutus_muu--year-of-completion
    pohjakoulutus_ulk--year-of-completion
    pohjakoulutus_yo_ammatillinen--marticulation-year-of-completion
    pohjakoulutus_yo_kansainvalinen_suomessa--eb--year-of-completion
    pohjakoulutus_yo_kansainvalinen_suomessa--ib--year-of-completion
    pohjakoulutus_yo_kansainvalinen_suomessa--rb--year-of-completion
    pohjakoulutus_yo_kansainvalinen_suomessa--year-of-completion
    pohjakoulutus_yo--no-year-of-completion
    pohjakoulutus_yo_ulkomainen--eb--year-of-completion
    pohjakoulutus_yo_ulkomainen--ib--year-of-completion
    pohjakoulutus_yo_ulkomainen--rb--year-of-completion
    pohjakoulutus_yo_ulkomainen--year-of-completion
    pohjakoulutus_yo--yes-year-of-completion
    pohjakoulutus_yo_ammatillinen--vocational-completion-year
    pohjakoulutus_kk--completion-date
""".split()
APPRENTICESHIP_QUESTION = "74fb6885-879d-4748-a2bc-aaeb32616ba1"
HIGHER_BASE_EDUCATION = "higher-completed-base-education"


@model(
    load="merge", keys=("hakemus_oid",), since=Since("dw_metadata_dbt_copied_at"),
    digests=(("hakemus_versio_id", ("hakemus_oid", "versio_id")),),
)
def int_ataru_hakemus(dw_ataru_hakemus: DataFrame, target: DataFrame | None) -> DataFrame:
    """Newest version of each application that names a person.

    An older version that arrives late does not replace a newer stored one.
    """
    # digests do not compress, so the shuffle carries the columns that this one is made of
    versions = dw_ataru_hakemus.drop("hakemus_versio_id")
    newest = latest.newest_per_key(versions, ["oid"], "versio_id", "muokattu").filter("henkilo_oid IS NOT NULL")
    newest = newest.withColumn("hakemus_versio_id", surrogate_key("oid", "versio_id")).select(*dw_ataru_hakemus.columns)
    if target is not None:
        kept = target.select(F.col("hakemus_oid").alias("oid"), F.struct("versio_id", "muokattu").alias("_stored"))
        stored = merge.matching(kept, newest, ["oid"])
        newest = newest.join(stored, ["oid"], "left").filter(
            F.col("_stored").isNull() | (F.struct("versio_id", "muokattu") >= F.col("_stored"))
        ).drop("_stored")
    years = ", ".join(f"`{q}` array<array<string>>" for q in COMPLETION_QUESTIONS)
    answers = newest.withColumn("_years", jsonx.record("tiedot", years)).withColumn(
        "_answers", jsonx.record("tiedot", f"`{APPRENTICESHIP_QUESTION}` string, `{HIGHER_BASE_EDUCATION}` string")
    )
    year_of = [(q, F.get(F.get(F.col("_years")[q], F.lit(0)), F.lit(0))) for q in COMPLETION_QUESTIONS]
    return answers.select(
        F.col("oid").alias("hakemus_oid"),
        *[c for c in newest.columns if c != "oid"],
        F.coalesce(F.col("tila") == "inactivated", F.lit(False)).alias("poistettu"),
        jsonx.at("hakemusmaksut", "state").alias("hakemusmaksun_tila"),
        (F.col("_answers")[APPRENTICESHIP_QUESTION] == "0").alias("kiinnostunut_oppisopimuksesta"),
        F.col("_answers")[HIGHER_BASE_EDUCATION].alias("pohjakoulutus_kk"),
        jsonx.build_named(year_of, keep_nulls=False).alias("pohjakoulutus_kk_valmistumisvuosi"),
    )


@model(
    load="merge", keys=("hakutoive_id",), parent=("hakemus_oid",), since=Since("dw_metadata_dbt_copied_at"),
    digests=(("hakutoive_id", ("hakemus_oid", "hakukohde_oid")), ("hakukohde_henkilo_id", ("hakukohde_oid", "henkilo_oid"))),
)
def int_ataru_hakutoive(int_ataru_hakemus: DataFrame) -> DataFrame:
    """One row per choice, numbered in order of preference.  Choices that a
    new version of the application no longer lists are flagged as deleted."""
    choices = int_ataru_hakemus.select(
        "hakemus_oid", "henkilo_oid", "hakukelpoisuus_asetettu_automaattisesti", "poistettu", "muokattu",
        "dw_metadata_dbt_copied_at", F.posexplode(jsonx.elements("hakukohde")).alias("_place", "hakukohde_oid"),
    )
    return choices.select(
        choice_key(),
        target_person_key(),
        "hakemus_oid",
        "henkilo_oid",
        "hakukohde_oid",
        (F.col("_place") + 1).cast("bigint").alias("hakutoivenumero"),
        jsonx.holds("hakukelpoisuus_asetettu_automaattisesti", F.col("hakukohde_oid")).alias(
            "hakukelpoisuus_asetettu_automaattisesti"
        ),
        "poistettu",
        "muokattu",
        "dw_metadata_dbt_copied_at",
    )


# --- shared registers ---


@model()
def int_koodisto_koodi(dw_koodisto_koodi: DataFrame) -> DataFrame:
    uri = F.concat("koodiuri", F.lit("#"), F.col("koodiversio").cast("string"))
    newest = current(dw_koodisto_koodi.withColumn("versioitu_koodiuri", uri), "versioitu_koodiuri")
    return newest.select(
        "koodistouri", "versioitu_koodiuri", "koodiuri", "koodiarvo", "koodiversio",
        jsonx.names("koodinimi_fi", "koodinimi_sv", "koodinimi_en").alias("koodinimi"),
        F.col("koodinimi_fi").alias("nimi_fi"), F.col("koodinimi_sv").alias("nimi_sv"),
        F.col("koodinimi_en").alias("nimi_en"), "tila", "voimassaalkupvm", "voimassaloppupvm",
    )


@model(load="merge", keys=("henkilo_oid",), since=Since("muokattu"))
def int_onr_henkilo(dw_onr_henkilo: DataFrame) -> DataFrame:
    """Persons with the id of their master record; a master is its own."""
    return dw_onr_henkilo.withColumns(
        {"master": F.col("master_oid").isNull(), "master_oid": F.coalesce("master_oid", "henkilo_oid")}
    )


@model()
def int_organisaatio_ryhma(dw_organisaatio_ryhma: DataFrame) -> DataFrame:
    return dw_organisaatio_ryhma.select(
        F.col("oid").alias("hakukohderyhma_oid"), jsonx.names("nimi_fi", "nimi_sv", "nimi_en").alias("hakukohderyhma_nimi")
    )


@model()
def int_ohjausparametrit_parameter(dw_ohjausparametrit_parameter: DataFrame) -> DataFrame:
    return current(dw_ohjausparametrit_parameter, "haku_oid").select(
        "haku_oid", "vastaanotto_paattyy", "hakijakohtainen_paikan_vastaanottoaika", "jarjestetyt_hakutoiveet", "arvot"
    )


# --- selection ---


@model(load="merge", keys=("valintakoe_hakemus_id",), newer="muokattu", since=Since("dw_metadata_dbt_copied_at"))
def int_valintalaskenta_pistetieto(dw_valintalaskenta_pistetieto: DataFrame) -> DataFrame:
    return latest.newest_with_ties(dw_valintalaskenta_pistetieto, ["valintakoe_hakemus_id"], "muokattu")


@model(load="merge", keys=("hakemusoid",), newer="muokattu", since=Since(STORED))
def int_valintalaskenta_valintakoe_osallistuminen(dw_valintalaskenta_valintakoe_osallistuminen: DataFrame) -> DataFrame:
    return latest.newest_with_ties(dw_valintalaskenta_valintakoe_osallistuminen, ["hakemusoid"], "muokattu")


@model()
def int_valintaperusteet_avain(dw_valintaperusteet_avain: DataFrame) -> DataFrame:
    return current(dw_valintaperusteet_avain, "hakukohde_oid").select("hakukohde_oid", "muokattu", "data", *METADATA)


@model()
def int_valintarekisteri_hyvaksyttyjulkaistuhakutoive(dw_valintarekisteri_hyvaksyttyjulkaistuhakutoive: DataFrame):
    return current(dw_valintarekisteri_hyvaksyttyjulkaistuhakutoive, "hakukohde_henkilo_id").select(
        "hakukohde_henkilo_id", "hakukohde_oid", "henkilo_oid", "hyvaksyttyjajulkaistu"
    )


@model()
def int_valintarekisteri_ilmoittautuminen(dw_valintarekisteri_ilmoittautuminen: DataFrame) -> DataFrame:
    return current(dw_valintarekisteri_ilmoittautuminen, "ilmoittautuminen_id").select(
        target_person_key(), "ilmoittautuminen_id", "hakukohde_oid", "henkilo_oid", "ilmoittaja", "selite", "tila"
    )


@model()
def int_valintarekisteri_jonosija(dw_valintarekisteri_jonosija: DataFrame) -> DataFrame:
    return dw_valintarekisteri_jonosija.select(
        "jonosija_id", queue_key(), choice_key(), "hakemus_oid", "hakukohde_oid", "valintatapajono_oid",
        "hyvaksytty_harkinnanvaraisesti", "jonosija", "varasijan_numero", "onko_muuttunut_viime_sijoittelussa",
        "prioriteetti", "pisteet", "siirtynyt_toisesta_valintatapajonosta", "sijoitteluajo_id",
    )


@model()
def int_valintarekisteri_lukuvuosimaksu(dw_valintarekisteri_lukuvuosimaksu: DataFrame) -> DataFrame:
    return current(dw_valintarekisteri_lukuvuosimaksu, "hakukohde_henkilo_id").select(
        "hakukohde_henkilo_id", "hakukohde_oid", "henkilo_oid", "maksun_tila"
    )


@model(load="merge", keys=("valinnantulos_id",))
def int_valintarekisteri_valinnantulos(dw_valintarekisteri_valinnantulos: DataFrame, target: DataFrame | None) -> DataFrame:
    """Newest result per queue and application.  The stored table keeps only
    the day of a decision; results of that same day are merged again."""
    newest = current(dw_valintarekisteri_valinnantulos, "valinnantulos_id")
    if target is not None:
        kept = target.select("valinnantulos_id", F.col("valintatiedon_pvm").cast("timestamp").alias("_stored"))
        stored = merge.matching(kept, newest, ["valinnantulos_id"])
        newest = newest.join(stored, ["valinnantulos_id"], "left").filter(
            F.col("_stored").isNull() | (F.col("muokattu") > F.col("_stored"))
        )
    return newest.select(
        "valinnantulos_id", choice_key(), queue_key(), "hakukohde_oid", "valintatapajono_oid", "hakemus_oid", "henkilo_oid",
        F.col("valinnantila").alias("valinnan_tila"),
        F.col("ehdollisestihyvaksyttavissa").alias("ehdollisesti_hyvaksyttavissa"),
        jsonx.build(
            en=F.col("ehdollisenhyvaksymisenehtoen"), sv=F.col("ehdollisenhyvaksymisenehtosv"),
            fi=F.col("ehdollisenhyvaksymisenehtofi"),
        ).alias("ehdollisen_hyvaksymisen_ehto"),
        jsonx.build(
            en=F.col("valinnantilankuvauksentekstien"), sv=F.col("valinnantilankuvauksentekstisv"),
            fi=F.col("valinnantilankuvauksentekstifi"),
        ).alias("valinnantilan_kuvauksen_teksti"),
        "julkaistavissa", "hyvaksyperuuntunut", F.to_date("muokattu").alias("valintatiedon_pvm"),
    )


@model()
def int_valintarekisteri_valintatapajono(dw_valintarekisteri_valintatapajono: DataFrame) -> DataFrame:
    return dw_valintarekisteri_valintatapajono.select(
        F.col("oid").alias("valintatapajono_oid"), F.col("nimi").alias("valintatapajono_nimi"), "hakukohde_oid",
        "alinhyvaksyttypistemaara", "alkuperaisetaloituspaikat", "aloituspaikat", "eivarasijatayttoa", "hakeneet",
        "kaikkiehdontayttavathyvaksytaan", "poissaolevataytto", "prioriteetti",
        "sijoiteltuilmanvarasijasaantojaniidenollessavoimassa", "tasasijasaanto", "valintaesityshyvaksytty",
        "varasijantayttopaivat", "varasijat", "varasijojakaytetaanasti",
    )


@model()
def int_valintarekisteri_vastaanotto(dw_valintarekisteri_vastaanotto: DataFrame) -> DataFrame:
    """Newest answer that has not been withdrawn."""
    return current(dw_valintarekisteri_vastaanotto.filter("poistettu_aikaleima IS NULL"), "hakukohde_henkilo_id")


# --- education offers ---


@model()
def int_kouta_haku(dw_kouta_haku: DataFrame, raw_haunkohdejoukko: DataFrame) -> DataFrame:
    newest = current(dw_kouta_haku, "oid").withColumn("_group", text.find("kohdejoukkokoodiuri", "_(.+)#", 1))
    levels = raw_haunkohdejoukko.withColumnRenamed("haunkohdejoukko", "_group")
    start = seasons.start_json("koulutuksenalkamiskausi")
    named = newest.join(levels, ["_group"], "left").withColumns(
        {
            "haku_nimi": jsonx.names("nimi_fi", "nimi_sv", "nimi_en"),
            "koulutuksen_alkamiskausi_json": F.concat(F.lit("["), start, F.lit("]")),
        }
    )
    return named.withColumnsRenamed({"oid": "haku_oid", "koulutuksenalkamiskausi": "koulutuksen_alkamiskausi"}).drop(
        "_group", "nimi_fi", "nimi_sv", "nimi_en"
    )


@model()
def int_kouta_hakukohde(dw_kouta_hakukohde: DataFrame) -> DataFrame:
    newest = current(dw_kouta_hakukohde, "oid")
    return newest.withColumns(
        {
            "hakukohde_nimi": jsonx.names("nimi_fi", "nimi_sv", "nimi_en"),
            "haku_oid": F.col("hakuoid"),
            "organisaatio_oid": F.col("organisaatiooid"),
        }
    ).withColumnsRenamed(
        {
            "oid": "hakukohde_oid", "toteutusoid": "toteutus_oid", "jarjestyspaikkaoid": "jarjestyspaikka_oid",
            "externalid": "ulkoinen_tunniste", "valintaperusteid": "valintaperuste_id",
        }
    ).drop("nimi_fi", "nimi_sv", "nimi_en")


@model()
def int_kouta_koulutus(dw_kouta_koulutus: DataFrame) -> DataFrame:
    named = current(dw_kouta_koulutus, "oid").withColumn("koulutus_nimi", jsonx.names("nimi_fi", "nimi_sv", "nimi_en"))
    return named.withColumnsRenamed({"oid": "koulutus_oid", "organisaatiooid": "organisaatio_oid"}).drop(
        "nimi_fi", "nimi_sv", "nimi_en"
    )


@model()
def int_kouta_toteutus(dw_kouta_toteutus: DataFrame) -> DataFrame:
    """The Finnish and the English name prefer each other's text."""
    swapped = jsonx.build(
        en=F.coalesce("nimi_fi", "nimi_en", "nimi_sv"),
        sv=F.coalesce("nimi_sv", "nimi_fi", "nimi_en"),
        fi=F.coalesce("nimi_en", "nimi_fi", "nimi_sv"),
    )
    return current(dw_kouta_toteutus, "oid").withColumn("toteutus_nimi", swapped).withColumnsRenamed(
        {
            "oid": "toteutus_oid", "koulutusoid": "koulutus_oid", "organisaatiooid": "organisaatio_oid",
            "koulutuksenalkamiskausi": "koulutuksen_alkamiskausi",
        }
    ).drop("nimi_fi", "nimi_sv", "nimi_en")


@model()
def int_kouta_valintaperuste(dw_kouta_valintaperuste: DataFrame) -> DataFrame:
    named = current(dw_kouta_valintaperuste, "id").withColumn(
        "valintaperuste_nimi", jsonx.names("nimi_fi", "nimi_sv", "nimi_en")
    )
    return named.withColumnRenamed("id", "valintaperuste_id").drop("nimi_fi", "nimi_sv", "nimi_en")


@model()
def int_koutalight_koulutus(dw_koutalight_koulutus: DataFrame) -> DataFrame:
    from lakemart.sources.shred import fields, parse

    wanted = fields(
        """
        externalId=external_id tila nimi/* nimi:json=koulutus_nimi ownerOrg=omistaja_organisaatio
        createdAt:time_ntz=luotu metadata/kuvaus:json metadata/hakuaikaAlkaa:time_ntz=hakuaika_alkaa
        metadata/hakuaikaPaattyy:time_ntz=hakuaika_paattyy metadata/aloituspaikatLukumaara:int=aloituspaikat_lkm
        metadata/isTyovoimakoulutus:bool=is_tyovoimakoulutus metadata/johtaaTutkintoon:bool=johtaa_tutkintoon
        metadata/isMaksullinen:bool=is_maksullinen metadata/hakulomakeLinkki:json=hakulomake_linkki
        metadata/maksullisuuskuvaus:json=maksullisuus_kuvaus kielivalinta:json tarjoajat:json
        metadata/ammattinimikkeet:json metadata/asiasanat:json metadata/opetuskielet:json
        metadata/osaaminenUrit:json=osaaminen_urit_json
        """
    )
    newest = current(dw_koutalight_koulutus, "koulutus_id")
    return parse(F.col("data"), wanted, newest).select(
        "koulutus_id", *[f.column for f in wanted], "muokattu", *METADATA
    )


# --- achievements ---


def of_active(rows: DataFrame, int_ataru_hakemus: DataFrame) -> DataFrame:
    """Without the rows of applications that are no longer active."""
    return merge.purge(rows, int_ataru_hakemus.filter(F.col("tila") != "active"), ["hakemus_oid"])


PER_APPLICATION = dict(load="replace", keys=("hakemus_oid",), since=Since(STORED, inclusive=True), after=of_active)


@model(**PER_APPLICATION)
def int_supa_ensikertalainen(dw_supa_ensikertalainen: DataFrame) -> DataFrame:
    d = jsonx.record(
        "data",
        "henkiloOid string, hakuOid string, isEnsikertalainen string, "
        "menettamisenPeruste struct<peruste: string, paivamaara: string>",
    )
    return dw_supa_ensikertalainen.withColumn("d", d).select(
        "hakemus_oid",
        F.col("d.henkiloOid").alias("henkilo_oid"),
        F.col("d.hakuOid").alias("haku_oid"),
        F.col("d.isEnsikertalainen").cast("boolean").alias("isensikertalainen"),
        F.col("d.menettamisenPeruste.peruste").alias("menettamisen_peruste"),
        F.col("d.menettamisenPeruste.paivamaara").cast("timestamp").alias("menettamisen_paivamaara"),
        *METADATA,
    )


@model(**PER_APPLICATION)
def int_supa_harkinnanvaraisuus(dw_supa_harkinnanvaraisuus: DataFrame) -> DataFrame:
    rows = jsonx.records(
        jsonx.at("data", "harkinnanvaraisuudet"),
        "hakukohdeOid string, harkinnanvaraisuudenSyy string, yliajettu string",
    )
    return dw_supa_harkinnanvaraisuus.withColumn("r", F.explode(rows)).select(
        surrogate_key("hakemus_oid", "r.hakukohdeOid").alias("hakutoive_id"),
        "hakemus_oid",
        F.col("r.hakukohdeOid").alias("hakukohde_oid"),
        F.col("r.harkinnanvaraisuudenSyy").alias("harkinnanvaraisuus_syy"),
        F.col("r.yliajettu").cast("boolean").alias("harkinnanvaraisuus_yliajettu"),
        *METADATA,
    )


@model(**PER_APPLICATION)
def int_supa_valintadata(dw_supa_valintadata: DataFrame) -> DataFrame:
    return dw_supa_valintadata.select(
        "hakemus_oid", jsonx.at("data", "hakuOid").alias("haku_oid"), jsonx.at("data", "avainArvot").alias("keyvalues"), *METADATA
    )


@model(load="replace_changed", keys=("henkilo_oid",), since=Since(STAGED))
def int_supa_opiskeluoikeus(dw_supa_opiskeluoikeus: DataFrame) -> DataFrame:
    return current(dw_supa_opiskeluoikeus, "henkilo_oid", by="aikaleima")


# matriculation subject codes by exam kind and subject detail (fixed values)
YO_SUBJECTS = {
    "REAALI": "ET:RY UO:RO UE:RR",
    "A": "SA:SA EN:EA UN:HA VE:VA IT:TA RA:FA FI:CA RU:BA ES:PA PG:GA",
    "B": "SA:SB EN:EB UN:HB VE:VB IT:TB RA:FB FI:CB RU:BB ES:PB PG:GB",
    "C": "SA:SC EN:EC UN:HC VE:VC IT:TC RA:FC FI:CC RU:BC ES:PC PG:GC IS:IC ZA:DC KR:KC QS:QC LA:L7",
    "AI": "IS:I RU:O FI:A ZA:Z QS:W",
    "VI2": "RU:O5 FI:A5",
    "PITKA": "MA:M",
    "LYHYT": "MA:N",
    "SAKSALKOUL": "SA:S9",
    "KYPSYYS": "LA:L1",
    "D": "LA:L1",
}
DETAIL_IS_CODE = "AINEREAALI"
UNKNOWN_SUBJECT = "XXX"


def yo_subject(exam: str, detail: str) -> Column:
    """Subject code of a matriculation grade by table lookup.  A detail that
    the table lacks is shown as 'exam_detail', an unknown exam as 'XXX'."""
    known = {f"{e}:{pair.split(':')[0]}": pair.split(":")[1] for e, pairs in YO_SUBJECTS.items() for pair in pairs.split()}
    table = F.create_map(*[F.lit(x) for item in known.items() for x in item])
    listed = F.try_element_at(table, F.concat(exam, F.lit(":"), detail))
    return (
        F.when(F.col(exam) == DETAIL_IS_CODE, F.col(detail))
        .when(F.col(exam).isin(*YO_SUBJECTS), F.coalesce(listed, F.concat(exam, F.lit("_"), detail)))
        .otherwise(UNKNOWN_SUBJECT)
    )


@model(load="replace", keys=("resourceid",), since=Since(STORED))
def int_sure_arvosana(dw_sure_arvosana: DataFrame) -> DataFrame:
    """Newest grades among the rows that are not deleted."""
    return current(dw_sure_arvosana.filter("deleted != true"), "resourceid").select(
        "resourceid", "suoritus", "arvosana", "asteikko", "aine", "lisatieto", "valinnainen", "muokattu", "deleted",
        "pisteet", "myonnetty", "source", "jarjestys", "arvot", yo_subject("aine", "lisatieto").alias("yo_aine"), STORED,
    )


@model()
def int_sure_ensikertalainen(dw_sure_ensikertalainen: DataFrame) -> DataFrame:
    return dw_sure_ensikertalainen.select(
        F.col("hakuoid").alias("haku_oid"), F.col("henkilooid").alias("henkilo_oid"), "isensikertalainen",
        "menettamisenperuste", "menettamisenpaivamaara",
    )


@model()
def int_sure_harkinnanvaraisuus(dw_sure_harkinnanvaraisuus: DataFrame) -> DataFrame:
    choices = jsonx.records("hakutoiveet", "hakukohdeOid string, harkinnanvaraisuudenSyy string")
    return dw_sure_harkinnanvaraisuus.withColumn("c", F.explode(choices)).select(
        surrogate_key("hakemusoid", "c.hakukohdeOid").alias("hakutoive_id"),
        F.col("hakemusoid").alias("hakemus_oid"),
        F.col("c.hakukohdeOid").alias("hakukohde_oid"),
        F.col("c.harkinnanvaraisuudenSyy").alias("harkinnanvaraisuuden_syy"),
    )


@model()
def int_sure_opiskelija(dw_sure_opiskelija: DataFrame) -> DataFrame:
    return current(dw_sure_opiskelija, "resourceid").select(
        "resourceid", F.col("oppilaitosoid").alias("oppilaitos_oid"), "luokkataso", "luokka",
        F.col("henkilooid").alias("henkilo_oid"), "alkupaiva", "loppupaiva", "muokattu", "poistettu", "source",
    )


@model()
def int_sure_opiskeluoikeus(dw_sure_opiskeluoikeus: DataFrame) -> DataFrame:
    return current(dw_sure_opiskeluoikeus, "resourceid").select(
        "resourceid", "alkupaiva", "loppupaiva", "henkilooid", "komo", "myontaja", "source", "muokattu", "poistettu"
    )


@model(load="merge", keys=("resourceid",), newer="muokattu")
def int_sure_suoritus(dw_sure_suoritus: DataFrame) -> DataFrame:
    return latest.newest_with_ties(dw_sure_suoritus, ["resourceid"], "muokattu").select(
        "resourceid", "komo", "myontaja", "tila", "valmistuminen", F.col("henkilooid").alias("henkilo_oid"),
        "yksilollistaminen", "suorituskieli", "muokattu", "poistettu", "source", "vahvistettu", "arvot",
    )
