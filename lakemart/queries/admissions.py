"""Admission marts over documents derived from the test tables."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.keys import surrogate_key
from lakemart.plans.catalog import MODELS, evaluate, in_order
from lakemart.plans.model import Model
from lakemart.plans.shapes import SHAPES
from lakemart.queries import admission_documents as documents
from lakemart.queries.registry import Source, query
from lakemart.session import work_path

NOW = "2024-06-01 00:00:00"


# read by many models, so written to the shared folder once per session
SHARED = {
    "int_koodisto_koodi", "int_koodisto_relaatio", "int_ataru_hakemus", "int_organisaatio", "int_hakutoive",
    "int_koodisto_koulutus_alat_ja_asteet", "int_onr_henkilo", "pub_dim_koulutus", "pub_dim_hakukohde", "pub_dim_henkilo",
    "stg_valintarekisteri_jonosija",
}
# wide rows of which most readers take a few columns: stored only where the models to build read them more than once
WIDE = {"int_hakutoive", "int_ataru_hakemus", "stg_valintarekisteri_jonosija", "pub_dim_henkilo"}
_CHOICE = "hakemus_oid hakukohde_oid henkilo_oid hakutoivenumero vastaanottotieto valintatieto"
_ANSWERS = "hakemus_oid lomake_id hakukohde tiedot dw_metadata_dw_stored_at"
# wide model -> columns that a reader takes of it; a reader that is not named takes all, or passes on what its own readers take
TAKEN = {
    "int_ataru_hakemus": {
        "int_ataru_hakutoive": "hakemus_oid henkilo_oid hakukelpoisuus_asetettu_automaattisesti poistettu muokattu dw_metadata_dbt_copied_at hakukohde",
        "int_hakutoive": "hakemus_oid haku_oid henkilo_oid",
        "int_hakutoive_kk": "hakemus_oid haku_oid tila kasittelymerkinnat tiedot dw_metadata_dw_stored_at",
        "int_maksuvelvollisuus": "hakemus_oid kasittelymerkinnat",
        "int_ataru_soratietoja": "hakemus_oid hakukohde tiedot dw_metadata_dw_stored_at",
        "int_kaksoistutkinto_hakukohde": _ANSWERS,
        "int_urheilijatutkinto_hakukohde": _ANSWERS,
        "pub_fct_raportti_hakijat_toinen_aste": "hakemus_oid haku_oid",
        "pub_dim_henkilo": "henkilo_oid hakemus_oid lahiosoite postinumero postitoimipaikka kotikunta ulk_kunta asuinmaa sahkoposti puhelin "
        "pohjakoulutuksen_maa_toinen_aste koulutusmarkkinointilupa valintatuloksen_julkaisulupa sahkoinenviestintalupa hakemusmaksun_tila",
    },
    "int_hakutoive": {
        "int_hakutoive_kk": "hakemus_oid hakukohde_oid",
        "pub_fct_raportti_hakijat_kk": "hakemus_oid hakukohde_oid henkilo_oid haku_oid",
    },
    "pub_dim_hakutoive": {
        "pub_fct_raportti_tilastoraportti_kk": f"{_CHOICE} ensikertalainen",
        "pub_fct_raportti_tilastoraportti_kk_hakutoive": f"{_CHOICE} ensikertalainen",
        "pub_fct_raportti_tilastoraportti_toinen_aste": f"{_CHOICE} harkinnanvaraisuuden_syy",
        "pub_fct_raportti_tilastoraportti_2aste_hakutoive": f"{_CHOICE} harkinnanvaraisuuden_syy",
    },
}
# digests do not compress: stored rows have the columns that they are made of, and readers make them again
DIGESTS = {
    "stg_valintarekisteri_jonosija": dict([SHAPES["valintarekisteri_jonosija"].key]),
    "int_hakutoive": {
        "hakutoive_id": ("hakemus_oid", "hakukohde_oid"), "hakukohde_henkilo_id": ("hakukohde_oid", "henkilo_oid"),
        "henkilo_hakemus_id": ("henkilo_oid", "hakemus_oid"),
    },
    "pub_dim_henkilo": {"henkilo_hakemus_id": ("henkilo_oid", "hakemus_oid")},
}


@dataclass(frozen=True)
class Kept:
    """Where a model is stored, and which columns of it (None: all)."""

    path: str
    columns: frozenset[str] | None

    def has(self, columns: frozenset[str] | None) -> bool:
        return self.columns is None or (columns is not None and columns <= self.columns)


# (application, folder) -> model -> where it is stored
STORED: dict[tuple[str, str], dict[str, Kept]] = {}


def forget() -> None:
    """Derive and store everything again at the next query."""
    STORED.clear()


def readings(wanted: list[str], models: dict[str, Model]) -> Counter:
    """How often the wanted models lead to each model: one that is not stored is
    derived again for every reader, and so is what it reads."""
    times = Counter(wanted)
    for name in reversed(in_order(models, wanted)):
        again = 1 if name in SHARED - WIDE or (name in WIDE and times[name] > 1) else times[name]
        for table in models[name].tables:
            times[table] += again
    return times


def taken(name: str, wanted: list[str], models: dict[str, Model] = MODELS) -> frozenset[str] | None:
    """Columns of a model that the wanted models need; None for all."""
    if name in wanted or name not in TAKEN:
        return None
    columns: frozenset[str] = frozenset()
    for reader in in_order(models, wanted):
        if name in models[reader].tables:
            own = frozenset(TAKEN[name][reader].split()) if reader in TAKEN[name] else taken(reader, wanted, models)
            if own is None:
                return None
            columns |= own
    return columns


def marts(t: Source, *wanted: str) -> list[DataFrame]:
    """Models over the derived documents.  A shared model that an earlier
    query of the session has stored is read, not built again."""
    spark = t.spark
    known = STORED.setdefault((spark.sparkContext.applicationId, t.folder), {})
    stored = {name: kept for name, kept in known.items() if kept.has(taken(name, list(wanted)))}
    derive = documents.reader(t)
    open_models = {name: m for name, m in MODELS.items() if name not in stored}
    missing = [name for name in wanted if name in open_models]
    read_by = readings(missing, open_models)

    def kept_rows(name: str) -> DataFrame:
        rows = spark.read.parquet(stored[name].path)
        made = {digest: surrogate_key(*parts) for digest, parts in DIGESTS.get(name, {}).items() if {*parts} <= {*rows.columns}}
        return rows.withColumns(made) if made else rows

    def read(name: str) -> DataFrame:
        return kept_rows(name) if name in stored else derive(name)

    def store(name: str, df: DataFrame) -> DataFrame:
        if name not in SHARED or (name in WIDE and read_by[name] < 2):
            return df
        path, columns = work_path(spark, name), taken(name, missing, open_models)
        digests = DIGESTS.get(name, {})
        needed = df.columns if columns is None else {*columns, *(p for d in columns & digests.keys() for p in digests[d])}
        df.select(*[c for c in df.columns if c in needed and c not in digests]).write.parquet(path)
        known[name] = stored[name] = Kept(path, columns)
        return kept_rows(name).select(*[c for c in df.columns if c in needed])

    built = evaluate(read, missing, F.lit(NOW).cast("timestamp"), open_models, store)
    return [built[name] if name in built else read(name) for name in wanted]


# the derived choices and results, for the SQL twins
CHOICES = """
    line AS (SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_returnflag AS flag, l_linestatus AS st FROM lineitem),
    result AS (SELECT *, o_custkey AS ck FROM line JOIN orders ON o_orderkey = ok
               QUALIFY row_number() OVER (PARTITION BY ok, pk ORDER BY ln, sk, flag, st) = 1),
    choice AS (SELECT *, row_number() OVER (PARTITION BY ok ORDER BY ln, pk) AS nr FROM result),
    valid AS (SELECT * FROM choice WHERE NOT (o_orderstatus = 'P' AND o_totalprice > 400000))
"""
STATE = """
    CASE WHEN flag = 'R' THEN CASE WHEN sk % 5 = 0 THEN 'HARKINNANVARAISESTI_HYVAKSYTTY' ELSE 'HYVAKSYTTY' END
         WHEN flag = 'A' AND st = 'F' THEN 'VARASIJALTA_HYVAKSYTTY' WHEN flag = 'A' THEN 'VARALLA'
         WHEN st = 'F' THEN 'PERUNUT' ELSE 'HYLATTY' END
"""
REGISTER = """
    taken AS (SELECT ck, pk, CASE sk % 3 WHEN 0 THEN 'VASTAANOTTANUT_SITOVASTI' WHEN 1 THEN 'PERUUTETTU'
                     ELSE 'EHDOLLISESTI_VASTAANOTTANUT' END AS taken
              FROM result WHERE flag = 'R' QUALIFY row_number() OVER (PARTITION BY ck, pk ORDER BY ok DESC) = 1),
    enrolled AS (SELECT ck, pk, CASE sk % 4 WHEN 0 THEN 'LASNA_SYKSY' WHEN 1 THEN 'POISSA'
                     WHEN 2 THEN 'LASNA_KOKO_LUKUVUOSI' ELSE 'EI_TEHTY' END AS enrolled
              FROM result WHERE flag <> 'N' QUALIFY row_number() OVER (PARTITION BY ck, pk ORDER BY ok DESC) = 1)
"""


@query(
    f"""
    WITH {CHOICES}
    SELECT 'A' || o_orderkey AS hakemus_oid, 'P' || o_custkey AS henkilo_oid, 'H' || left(o_orderpriority, 1) AS haku_oid,
           CAST(2 AS INT) AS versio_id, o_orderstatus = 'P' AND o_totalprice > 400000 AS poistettu,
           CAST(CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 2 END AS INT) AS sukupuoli,
           CASE WHEN n IS NULL THEN 0 ELSE n END AS choices
    FROM orders LEFT JOIN (SELECT ok, count(*) AS n FROM choice GROUP BY ok) ON ok = o_orderkey
    """
)
def mart_applications(t: Source) -> DataFrame:
    """Newest versions out of two deliveries of applications."""
    (applications,) = marts(t, "int_ataru_hakemus")
    return applications.select(
        "hakemus_oid", "henkilo_oid", "haku_oid", "versio_id", "poistettu", "sukupuoli",
        F.json_array_length("hakukohde").cast("bigint").alias("choices"),
    )


@query(
    f"""
    WITH {CHOICES}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, 'A' || ok AS hakemus_oid,
           '{documents.TARGET}' || pk AS hakukohde_oid, nr AS hakutoivenumero
    FROM valid
    """
)
def mart_choices(t: Source) -> DataFrame:
    (choices,) = marts(t, "int_ataru_hakutoive")
    return choices.filter("NOT poistettu").select("hakutoive_id", "hakemus_oid", "hakukohde_oid", "hakutoivenumero")


@query(
    f"""
    WITH {CHOICES}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, {STATE} AS valintatieto,
           flag = 'R' AND sk % 2 = 0 AS ehdollisesti_hyvaksytty,
           strftime(make_timestamp((1704067200 + ok) * 1000000), '%Y-%m-%d') AS paiva, 1 AS queues
    FROM result
    """
)
def mart_selection(t: Source) -> DataFrame:
    """Best state of each choice over its queues."""
    (selection,) = marts(t, "int_valinta")
    return selection.select(
        "hakutoive_id", "valintatieto", "ehdollisesti_hyvaksytty",
        F.date_format("valintatiedon_pvm", "yyyy-MM-dd").alias("paiva"), F.json_array_length("valintatapajonot").alias("queues"),
    )


@query(
    f"""
    WITH {CHOICES}, {REGISTER},
    published AS (SELECT ck, pk, make_timestamp((1719835200 + CAST(sk AS BIGINT) * 3600) * 1000000) AS shown FROM result
                  WHERE flag = 'R' QUALIFY row_number() OVER (PARTITION BY ck, pk ORDER BY ok DESC) = 1),
    latest AS (SELECT *, greatest(TIMESTAMP '2024-07-12 15:00:00', shown + INTERVAL 14 DAY) AS latest FROM valid
               LEFT JOIN published USING (ck, pk))
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id,
           CASE WHEN o_orderpriority LIKE '5%' THEN -1 ELSE nr END AS hakutoivenumero, taken AS vastaanottotieto,
           enrolled AS ilmoittautumisen_tila, {STATE} AS valintatieto, ck % 4 = 0 AS ensikertalainen,
           strftime(date_trunc('day', latest) + INTERVAL 15 HOUR + CASE WHEN hour(latest) * 60 + minute(latest) > 900
                    THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%d %H:%M') AS deadline
    FROM latest LEFT JOIN taken USING (ck, pk) LEFT JOIN enrolled USING (ck, pk)
    """
)
def mart_choices_complete(t: Source) -> DataFrame:
    (choices,) = marts(t, "int_hakutoive")
    return choices.select(
        "hakutoive_id", "hakutoivenumero", "vastaanottotieto", "ilmoittautumisen_tila", "valintatieto", "ensikertalainen",
        F.date_format("viimeinen_vastaanottopaiva", "yyyy-MM-dd HH:mm").alias("deadline"),
    )


PERSON = """
    person AS (SELECT c_custkey AS ck, CASE WHEN c_custkey % 7 = 3 THEN c_custkey - 1 ELSE c_custkey END AS master FROM customer),
    described AS (SELECT person.ck, master, CASE c_mktsegment WHEN 'BUILDING' THEN 'fi' WHEN 'MACHINERY' THEN 'sv' ELSE 'muu' END AS aidinkieli,
                         CAST(CASE WHEN c_nationkey < 10 THEN 1 WHEN c_nationkey < 15 THEN 2 ELSE 3 END AS INT) AS kansalaisuusluokka,
                         CASE WHEN c_nationkey < 10 THEN '246' WHEN c_nationkey < 15 THEN '752' ELSE '840' END AS kansalaisuus,
                         CAST(master % 2 + 1 AS INT) AS sukupuoli
                  FROM person JOIN customer ON c_custkey = master)
"""


@query(
    f"""
    WITH {PERSON}
    SELECT md5('P' || o_custkey || '-A' || o_orderkey) AS henkilo_hakemus_id, 'P' || master AS master_oid, aidinkieli AS aidinkieliluokka,
           kansalaisuusluokka, kansalaisuus, sukupuoli, n_name AS town
    FROM orders JOIN described ON ck = o_custkey JOIN nation ON n_nationkey = o_custkey % 25
    """
)
def mart_persons(t: Source) -> DataFrame:
    """Applicants described by their master record."""
    (persons,) = marts(t, "pub_dim_henkilo")
    return persons.select(
        "henkilo_hakemus_id", "master_oid", "aidinkieliluokka", "kansalaisuusluokka", "kansalaisuus", "sukupuoli",
        F.get_json_object("kotikunta_nimi", "$.fi").alias("town"),
    )


@query(
    """
    WITH c AS (SELECT c_custkey, unnest(CASE WHEN c_nationkey < 5 THEN ['246'] WHEN c_nationkey < 10 THEN ['840', '246']
                      WHEN c_nationkey < 15 THEN ['840', '752'] ELSE ['840'] END) AS code FROM customer),
    ranked AS (SELECT *, CAST(CASE code WHEN '246' THEN 1 WHEN '752' THEN 2 ELSE 3 END AS INT) AS class FROM c)
    SELECT 'P' || c_custkey AS henkilo_oid, code AS kansalaisuus, class AS kansalaisuusluokka, 'country ' || code AS name_fi,
           row_number() OVER (PARTITION BY c_custkey ORDER BY class, code) = 1 AS priorisoitu_kansalaisuus
    FROM ranked
    """
)
def mart_citizenships(t: Source) -> DataFrame:
    (rows,) = marts(t, "int_onr_kansalaisuus")
    return rows.select(
        "henkilo_oid", "kansalaisuus", "kansalaisuusluokka",
        F.get_json_object("kansalaisuus_nimi", "$.fi").alias("name_fi"), "priorisoitu_kansalaisuus",
    )


TARGETS = """
    target AS (SELECT p_partkey, p_size,
        CASE WHEN p_size % 2 = 1 THEN 'kausi_k#1' WHEN p_size % 10 = 0 THEN 'kausi_s#1'
             WHEN p_size % 5 = 0 THEN 'kausi_s#1' END AS season,
        p_size % 6 AS kind FROM part)
"""


@query(
    f"""
    WITH {TARGETS}
    SELECT '{documents.TARGET}' || p_partkey AS hakukohde_oid, 'K' || kind AS koulutus_oid, season AS koulutuksen_alkamiskausi_koodiuri,
           CAST(CASE WHEN p_size % 2 = 1 THEN 2025 WHEN season IS NOT NULL THEN 2024 END AS DOUBLE) AS koulutuksen_alkamisvuosi,
           CAST(CASE kind WHEN 5 THEN 5 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 3 END AS INT) AS tutkinnon_taso_sykli,
           '["am","yo"]' AS pohjakoulutuskoodit, '["oppilaitoksenopetuskieli_1","oppilaitoksenopetuskieli_2"]' AS oppilaitoksen_opetuskieli,
           'O' || p_partkey % 100 AS jarjestyspaikka_oid, CAST(p_size AS BIGINT) AS hakukohteen_aloituspaikat,
           CASE WHEN s.s_suppkey IS NULL OR s.s_suppkey < 10 THEN 'none' ELSE 'O' || p_partkey % 100 END AS office,
           CASE WHEN s.s_suppkey IS NULL THEN NULL ELSE n_name END AS town
    FROM target LEFT JOIN supplier s ON s.s_suppkey = p_partkey % 100 LEFT JOIN nation ON n_nationkey = s.s_nationkey
    """
)
def mart_targets(t: Source) -> DataFrame:
    """Study targets with start season, degree level, place and languages."""
    (targets,) = marts(t, "pub_dim_hakukohde")
    return targets.select(
        "hakukohde_oid", "koulutus_oid", "koulutuksen_alkamiskausi_koodiuri", "koulutuksen_alkamisvuosi",
        "tutkinnon_taso_sykli", "pohjakoulutuskoodit", "oppilaitoksen_opetuskieli", "jarjestyspaikka_oid",
        "hakukohteen_aloituspaikat", F.coalesce("toimipiste", F.lit("none")).alias("office"),
        F.get_json_object("sijaintikunta_nimi", "$.fi").alias("town"),
    )
