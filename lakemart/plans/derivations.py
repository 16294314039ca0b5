"""What the rows of each model follow from, for the models that are derived again
in part.  A text names the input's column that holds the unit; a way leads there
over other tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions import jsonx
from lakemart.functions.keys import surrogate_key
from lakemart.plans.propagation import Derivation, Listed, Way, way

APPLICATIONS, CHOICES = "int_ataru_hakemus", "int_ataru_hakutoive"
SEARCH_TO_APPLICATION = f"{APPLICATIONS} haku_oid hakemus_oid"
PLACE_TO_APPLICATION = f"{CHOICES} hakukohde_henkilo_id hakemus_oid"
PERSON_TO_APPLICATION = f"{APPLICATIONS} henkilo_oid hakemus_oid"
MASTER_TO_PERSON = "int_onr_henkilo master_oid henkilo_oid"
CHOICE_TO_APPLICATION = f"{CHOICES} hakutoive_id hakemus_oid"


def _of(unit: str, **ways: str | Way | tuple[Way, ...]) -> Derivation:
    as_ways = lambda w: w if isinstance(w, tuple) else (w if isinstance(w, Way) else way(w),)
    return Derivation(unit, {name: as_ways(w) for name, w in ways.items()})


def _reviewed_choices() -> Column:
    """Choices that an application's reviews name."""
    reviews = jsonx.records("kasittelymerkinnat", "requirement string, hakukohde string, state string")
    return F.explode(F.transform(reviews, lambda r: surrogate_key("hakemus_oid", r["hakukohde"])))


#: Register entries of a choice are found by its place, results by the choice.
_REGISTER = way("hakukohde_henkilo_id", PLACE_TO_APPLICATION)
_CHOICE = way("hakutoive_id", CHOICE_TO_APPLICATION)


def _newest(table: str, key: str, unit: str | None = None) -> Derivation:
    """Newest version of each key of a history table."""
    return Derivation(unit or key, {table: (way(key),)})


DERIVATIONS: dict[str, Derivation] = {
    # newest state of registers
    "int_valintarekisteri_ilmoittautuminen": _newest("dw_valintarekisteri_ilmoittautuminen", "ilmoittautuminen_id"),
    "int_valintarekisteri_hyvaksyttyjulkaistuhakutoive": _newest("dw_valintarekisteri_hyvaksyttyjulkaistuhakutoive", "hakukohde_henkilo_id"),
    "int_valintarekisteri_lukuvuosimaksu": _newest("dw_valintarekisteri_lukuvuosimaksu", "hakukohde_henkilo_id"),
    "int_valintarekisteri_vastaanotto": _newest("dw_valintarekisteri_vastaanotto", "hakukohde_henkilo_id"),
    "int_valintarekisteri_jonosija": _newest("dw_valintarekisteri_jonosija", "jonosija_id"),
    "int_sure_opiskelija": _newest("dw_sure_opiskelija", "resourceid"),
    "int_sure_opiskeluoikeus": _newest("dw_sure_opiskeluoikeus", "resourceid"),
    "int_sure_harkinnanvaraisuus": _newest("dw_sure_harkinnanvaraisuus", "hakemusoid", "hakemus_oid"),
    "int_vastaanotto": _newest("int_valintarekisteri_vastaanotto", "hakukohde_henkilo_id"),
    "int_harkinnanvaraisuus": _newest("int_sure_harkinnanvaraisuus", "hakemus_oid"),
    "int_kouta_hakukohde": _newest("dw_kouta_hakukohde", "oid", "hakukohde_oid"),
    "int_kouta_toteutus": _newest("dw_kouta_toteutus", "oid", "toteutus_oid"),
    # results of a choice
    "int_hakutoive_valintatapajono": _of(
        "hakutoive_id", int_valintarekisteri_valinnantulos="hakutoive_id",
        int_valintarekisteri_jonosija=way(
            "hakemus_hakukohde_valintatapa_id", "int_valintarekisteri_valinnantulos hakemus_hakukohde_valintatapa_id hakutoive_id"
        ),
        int_valintarekisteri_valintatapajono=way("valintatapajono_oid", "int_valintarekisteri_valinnantulos valintatapajono_oid hakutoive_id"),
    ),
    "int_valinta": _newest("int_hakutoive_valintatapajono", "hakutoive_id"),
    "int_valintarekisteri": _of(
        "hakukohde_henkilo_id", int_vastaanotto="hakukohde_henkilo_id", int_valintarekisteri_ilmoittautuminen="hakukohde_henkilo_id"
    ),
    # what an application shows
    "int_hakutoive": _of(
        "hakemus_oid", int_ataru_hakutoive="hakemus_oid", int_ataru_hakemus="hakemus_oid", int_haku=way("haku_oid", SEARCH_TO_APPLICATION),
        int_valintarekisteri_hyvaksyttyjulkaistuhakutoive=_REGISTER, int_vastaanotto=_REGISTER, int_valintarekisteri_ilmoittautuminen=_REGISTER,
        int_valinta=_CHOICE, int_harkinnanvaraisuus=_CHOICE,
        # a person has few applications, a search has many
        int_ensikertalainen=way("henkilo_oid", PERSON_TO_APPLICATION),
    ),
    "gen_hakutoive": _of("hakemus_oid", int_hakutoive="hakemus_oid"),
    "pub_dim_hakutoive": _of("hakemus_oid", int_hakutoive="hakemus_oid"),
    "pub_fct_hakemus": _of("hakemus_oid", int_ataru_hakemus="hakemus_oid", int_pohjakoulutus="hakemus_oid"),
    "int_urheilijatutkinto_hakukohde": _of(
        "hakemus_oid", int_ataru_hakemus="hakemus_oid", int_lomake_hakukohde=way("lomake_id", f"{APPLICATIONS} lomake_id hakemus_oid")
    ),
    "int_maksuvelvollisuus": _of("hakutoive_id", int_ataru_hakemus=Listed("hakemus_oid", values=_reviewed_choices)),
    "pub_dim_maksuvelvollisuus": _of("hakutoive_id", int_maksuvelvollisuus="hakutoive_id"),
    "pub_dim_valinnantulos": _newest("int_valintarekisteri_valinnantulos", "hakemus_hakukohde_valintatapa_id"),
    "pub_dim_henkilo": _of(
        "hakemus_oid", int_ataru_hakemus="hakemus_oid",
        # a person's own record, and the master record that describes them
        int_onr_henkilo=(way("henkilo_oid", PERSON_TO_APPLICATION), way("henkilo_oid", MASTER_TO_PERSON, PERSON_TO_APPLICATION)),
        int_onr_kansalaisuus=way("henkilo_oid", MASTER_TO_PERSON, PERSON_TO_APPLICATION),
        int_onr_kansalaisuus_nimi=way("henkilo_oid", PERSON_TO_APPLICATION),
    ),
    "gen_henkilo": _of("henkilo_oid", int_onr_henkilo="henkilo_oid", int_onr_kansalaisuus="henkilo_oid"),
    "pub_dim_oppija_henkilo": _of(
        "oppija_oid", int_onr_henkilo="henkilo_oid", int_ataru_hakemus="henkilo_oid", int_sure_suoritus="henkilo_oid"
    ),
    "pub_fct_raportti_hakijat_kk": _of(
        "hakutoive_id", int_hakutoive="hakutoive_id", int_hakutoive_kk="hakutoive_id", pub_dim_maksuvelvollisuus="hakutoive_id",
        int_kouta_haku=way("haku_oid", "int_hakutoive haku_oid hakutoive_id"),
    ),
    "pub_fct_raportti_hakijat_toinen_aste": _of(
        "hakemus_oid", int_ataru_hakutoive="hakemus_oid", int_ataru_hakemus="hakemus_oid", int_kouta_haku=way("haku_oid", SEARCH_TO_APPLICATION),
        int_ataru_soratietoja="hakemus_oid", int_sure_harkinnanvaraisuus="hakemus_oid", int_kaksoistutkinto_hakukohde="hakemus_oid",
        int_urheilijatutkinto_hakukohde="hakemus_oid", int_pohjakoulutus="hakemus_oid", int_valintarekisteri_ilmoittautuminen=_REGISTER,
    ),
    # statistics: all choices of a target are counted again
    "pub_fct_raportti_tilastoraportti_kk": _of(
        "hakukohde_oid", pub_dim_hakutoive="hakukohde_oid", pub_dim_hakukohde="hakukohde_oid",
        pub_dim_henkilo=way("henkilo_hakemus_id", "pub_dim_hakutoive henkilo_hakemus_id hakukohde_oid"),
        int_valintarekisteri=way("hakukohde_henkilo_id", "pub_dim_hakutoive hakukohde_henkilo_id hakukohde_oid"),
        int_hakutoive_kk=way("hakutoive_id", "pub_dim_hakutoive hakutoive_id hakukohde_oid"),
        pub_dim_maksuvelvollisuus=way("hakutoive_id", "pub_dim_hakutoive hakutoive_id hakukohde_oid"),
    ),
    "pub_fct_raportti_tilastoraportti_toinen_aste": _of(
        "hakukohde_oid", pub_dim_hakutoive="hakukohde_oid", pub_dim_hakukohde="hakukohde_oid",
        pub_dim_koulutus=way("koulutus_oid", "pub_dim_hakukohde koulutus_oid hakukohde_oid"),
        pub_dim_henkilo=way("henkilo_hakemus_id", "pub_dim_hakutoive henkilo_hakemus_id hakukohde_oid"),
        int_vastaanotto=way("hakukohde_henkilo_id", "pub_dim_hakutoive hakukohde_henkilo_id hakukohde_oid"),
        int_valintarekisteri_ilmoittautuminen=way("hakukohde_henkilo_id", "pub_dim_hakutoive hakukohde_henkilo_id hakukohde_oid"),
    ),
    # the same facts per choice
    "pub_fct_raportti_tilastoraportti_kk_hakutoive": _of(
        "hakutoive_id", pub_dim_hakutoive="hakutoive_id", int_hakutoive_kk="hakutoive_id", pub_dim_maksuvelvollisuus="hakutoive_id",
        pub_dim_hakukohde=way("hakukohde_oid", "pub_dim_hakutoive hakukohde_oid hakutoive_id"),
        pub_dim_henkilo=way("henkilo_hakemus_id", "pub_dim_hakutoive henkilo_hakemus_id hakutoive_id"),
        int_valintarekisteri=way("hakukohde_henkilo_id", "pub_dim_hakutoive hakukohde_henkilo_id hakutoive_id"),
    ),
    "pub_fct_raportti_tilastoraportti_2aste_hakutoive": _of(
        "hakutoive_id", pub_dim_hakutoive="hakutoive_id",
        pub_dim_hakukohde=way("hakukohde_oid", "pub_dim_hakutoive hakukohde_oid hakutoive_id"),
        pub_dim_koulutus=way("koulutus_oid", "pub_dim_hakukohde koulutus_oid hakukohde_oid", "pub_dim_hakutoive hakukohde_oid hakutoive_id"),
        pub_dim_henkilo=way("henkilo_hakemus_id", "pub_dim_hakutoive henkilo_hakemus_id hakutoive_id"),
        int_vastaanotto=way("hakukohde_henkilo_id", "pub_dim_hakutoive hakukohde_henkilo_id hakutoive_id"),
        int_valintarekisteri_ilmoittautuminen=way("hakukohde_henkilo_id", "pub_dim_hakutoive hakukohde_henkilo_id hakutoive_id"),
    ),
}
