"""Declared types of the published tables, checked before anything is published.

A column holds text, JSON text included, unless it is named here.  Counts of the
statistics per target have the names of the flags of the statistics per choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakemart.operators.quality import ContractBroken

# tables with a contract (fixed values)
TABLES = """
    pub_dim_arvosana_yo pub_dim_haku pub_dim_hakukohde pub_dim_hakukohderyhma pub_dim_hakukohderyhma_ja_hakukohteet pub_dim_hakutoive
    pub_dim_henkilo pub_dim_kontrolli_haku pub_dim_koulutus pub_dim_koulutustoimija pub_dim_koulutustoimija_ja_toimipisteet
    pub_dim_maksuvelvollisuus pub_dim_oppilaitos pub_dim_oppilaitos_ja_toimipisteet pub_dim_organisaatio pub_dim_organisaatio_rakenne
    pub_dim_toimipiste pub_dim_toimipiste_ja_toimipisteet pub_dim_toteutus pub_dim_valinnantulos pub_fct_hakemus
    pub_fct_raportti_hakijat_kk pub_fct_raportti_hakijat_toinen_aste pub_fct_raportti_tilastoraportti_2aste_hakutoive
    pub_fct_raportti_tilastoraportti_kk pub_fct_raportti_tilastoraportti_kk_hakutoive pub_fct_raportti_tilastoraportti_toinen_aste
""".split()

# columns that are not text (fixed values)
KINDS = {
    "boolean": """
        alempi_kk_aste ylempi_kk_aste jatkotutkinto laakis ehdollisesti_hyvaksyttavissa ehdollisesti_hyvaksytty ensikertalainen ensisijainen
        hakukohteiden_priorisointi hyvaksyperuuntunut hyvaksytty ilmoittautunut jarjestaa_urheilijan_ammkoulutusta julkaistavissa
        kaksoistutkinto_kiinnostaa urheilijatutkinto_kiinnostaa kaytetaan_haun_aikataulua koulutusmarkkinointilupa sahkoinenviestintalupa
        valintatuloksen_julkaisulupa lasna poissa maksuvelvollinen on_valintakoe osallistui_paasykokeeseen sora_aiempi sora_terveys
        toinen_aste_onko_kaksoistutkinto turvakielto varasija vastaanottanut toive_1 toive_2 toive_3 toive_4 toive_5 toive_6 toive_7
    """,
    "int": """
        okm_ohjauksen_ala aloituspaikat_ensikertalaisille kansalaisuusluokka kk_tutkinnon_taso sukupuoli suunniteltukestokuukaudet
        suunniteltukestovuodet tutkinnon_taso_sykli koulutuksen_alkamisvuosi
    """,
    "bigint": """
        ensikertalaisia ensisijaisia hakijat hakukohteen_aloituspaikat valintaperusteiden_aloituspaikat hakutoivenumero hyvaksytyt ilm_yht
        maksuvelvollisia vastaanottaneet
    """,
    "date": "syntymaaika valintatiedon_pvm",
    "timestamp": "alkupvm lakkautuspvm viimeinen_vastaanottopaiva",
}
# where one table differs from the rule (fixed values)
COUNTS = "lasna poissa varasija toive_1 toive_2 toive_3 toive_4 toive_5 toive_6 toive_7".split()
APART = {
    "pub_dim_hakukohde": {"koulutuksen_alkamisvuosi": "double"},
    "pub_fct_raportti_hakijat_toinen_aste": {"pohjakoulutus": "int"},
    "pub_fct_raportti_tilastoraportti_kk": dict.fromkeys(COUNTS, "bigint"),
    "pub_fct_raportti_tilastoraportti_toinen_aste": dict.fromkeys(COUNTS, "bigint"),
}

_BY_COLUMN = {column: kind for kind, columns in KINDS.items() for column in columns.split()}


def declared(table: str, column: str) -> str:
    """Type of a column of a published table."""
    return APART.get(table, {}).get(column, _BY_COLUMN.get(column, "string"))


def contract(table: str, columns: list[str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{c}` {declared(table, c)}" for c in columns))


def keep(table: str, df: DataFrame) -> DataFrame:
    """Refuse a table with a contract that has a column of another type."""
    if table in TABLES:
        wrong = [f"{c} is {kind}, not {declared(table, c)}" for c, kind in df.dtypes if kind != declared(table, c)]
        if wrong:
            raise ContractBroken(f"{table}: {', '.join(wrong)}")
    return df
