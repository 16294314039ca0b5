"""Report tables of the admission marts over the derived documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.plans.catalog import raw_defaults, run
from lakemart.plans.checks import KEYS, report
from lakemart.queries import admission_documents as documents
from lakemart.queries.admissions import CHOICES, PERSON, REGISTER, STATE, TARGETS, marts
from lakemart.queries.registry import Source, query
from lakemart.session import work_path
from lakemart.sinks.versions import Tables

ROWS = f"""
    WITH {CHOICES}, {REGISTER}, {PERSON}, {TARGETS},
    facts AS (SELECT valid.*, {STATE} AS state, taken, enrolled, season, kind, master, aidinkieli, kansalaisuusluokka, kansalaisuus, sukupuoli,
                     CASE WHEN o_orderpriority LIKE '5%' THEN -1 ELSE nr END AS num, ck % 4 = 0 AS first_timer,
                     CASE WHEN nr = 1 THEN ck % 3 = 0 END AS obligated
              FROM valid JOIN described USING (ck) JOIN target ON p_partkey = pk
              LEFT JOIN taken USING (ck, pk) LEFT JOIN enrolled USING (ck, pk)),
    flags AS (SELECT *,
        (state = 'HYVAKSYTTY' AND taken IS DISTINCT FROM 'PERUUTETTU')
          OR (state = 'VARASIJALTA_HYVAKSYTTY' AND taken IS DISTINCT FROM 'PERUUTETTU') OR state = 'PERUNUT' AS hyvaksytty,
        taken IN ('VASTAANOTTANUT_SITOVASTI', 'EHDOLLISESTI_VASTAANOTTANUT') AS vastaanottanut,
        (season = 'kausi_s#1' AND enrolled IN ('LASNA_SYKSY', 'LASNA_KOKO_LUKUVUOSI'))
          OR (season = 'kausi_k#1' AND enrolled IN ('LASNA_KEVAT', 'LASNA_KOKO_LUKUVUOSI')) OR enrolled = 'LASNA_KOKO_LUKUVUOSI' AS lasna,
        (season = 'kausi_s#1' AND enrolled = 'POISSA_SYKSY') OR (season = 'kausi_k#1' AND enrolled = 'POISSA_KEVAT')
          OR enrolled IN ('POISSA', 'POISSA_KOKO_LUKUVUOSI') AS poissa,
        enrolled IS NOT NULL AND enrolled NOT IN ('EI_TEHTY', 'EI_ILMOITTAUTUNUT') AS ilmoittautunut
        FROM facts)
"""


def totals(*pairs: tuple[str, str]) -> str:
    return ", ".join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, c in pairs)


COMMON = [
    ("ensisijaisia", "num = 1"), ("hyvaksytyt", "hyvaksytty"), ("vastaanottaneet", "vastaanottanut"), ("lasna", "lasna"),
    ("poissa", "poissa"), ("ilm_yht", "ilmoittautunut"),
]


def nth(n: int) -> list[tuple[str, str]]:
    return [(f"toive_{i}", f"num = {i}") for i in range(1, n + 1)]


@query(
    f"""
    {ROWS}
    SELECT '{documents.TARGET}' || pk AS hakukohde_oid, aidinkieli, kansalaisuusluokka, sukupuoli, kansalaisuus,
           first_timer AS ensikertalainen, count(DISTINCT ck) AS hakijat,
           {totals(*COMMON, ("ensikertalaisia", "first_timer"), ("maksuvelvollisia", "obligated"), *nth(6))}
    FROM flags GROUP BY 1, 2, 3, 4, 5, 6
    """
)
def mart_statistics_higher(t: Source) -> DataFrame:
    (report,) = marts(t, "pub_fct_raportti_tilastoraportti_kk")
    return report


@query(
    f"""
    {ROWS}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, 'P' || master AS henkilo_oid, '{documents.TARGET}' || pk AS hakukohde_oid,
           aidinkieli, kansalaisuusluokka, sukupuoli, kansalaisuus, first_timer AS ensikertalainen, num = 1 AS ensisijainen,
           hyvaksytty, vastaanottanut, lasna, poissa, ilmoittautunut, obligated AS maksuvelvollinen,
           num = 1 AS toive_1, num = 2 AS toive_2, num = 3 AS toive_3, num = 4 AS toive_4, num = 5 AS toive_5, num = 6 AS toive_6
    FROM flags
    """
)
def mart_statistics_higher_choices(t: Source) -> DataFrame:
    (report,) = marts(t, "pub_fct_raportti_tilastoraportti_kk_hakutoive")
    return report


FIELDS = ", ".join(f"CAST(kind % 3 AS VARCHAR) AS koulutusalataso_{n}" for n in (1, 2, 3))


@query(
    f"""
    {ROWS}
    SELECT '{documents.TARGET}' || pk AS hakukohde_oid, {FIELDS}, CAST(NULL AS VARCHAR) AS harkinnanvaraisuuden_syy, sukupuoli,
           count(DISTINCT ck) AS hakijat, {totals(*COMMON, ("varasija", "state = 'VARALLA'"), *nth(7))}
    FROM flags GROUP BY 1, 2, 3, 4, 5, 6
    """
)
def mart_statistics_secondary(t: Source) -> DataFrame:
    (report,) = marts(t, "pub_fct_raportti_tilastoraportti_toinen_aste")
    return report


@query(
    f"""
    {ROWS}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, 'P' || master AS henkilo_oid, '{documents.TARGET}' || pk AS hakukohde_oid,
           {FIELDS}, CAST(NULL AS VARCHAR) AS harkinnanvaraisuuden_syy, sukupuoli, num = 1 AS ensisijainen, state = 'VARALLA' AS varasija,
           hyvaksytty, vastaanottanut, lasna, poissa, ilmoittautunut,
           num = 1 AS toive_1, num = 2 AS toive_2, num = 3 AS toive_3, num = 4 AS toive_4, num = 5 AS toive_5, num = 6 AS toive_6,
           num = 7 AS toive_7
    FROM flags
    """
)
def mart_statistics_secondary_choices(t: Source) -> DataFrame:
    (report,) = marts(t, "pub_fct_raportti_tilastoraportti_2aste_hakutoive")
    return report


@query(
    f"""
    WITH {CHOICES}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, 'P' || ck AS henkilo_oid,
           CASE WHEN nr = 1 THEN CASE WHEN o_totalprice > 100000 THEN 'eligible' ELSE 'uneligible' END END AS hakukelpoisuus,
           '["yo"]' AS pohjakoulutus,
           CASE WHEN nr = 1 THEN CASE WHEN ck % 3 = 0 THEN 'obligated' ELSE 'not-obligated' END END AS maksuvelvollisuus
    FROM valid WHERE o_orderpriority < '3'
    """
)
def mart_applicants_higher(t: Source) -> DataFrame:
    (report,) = marts(t, "pub_fct_raportti_hakijat_kk")
    return report


@query(
    f"""
    WITH {CHOICES}, {REGISTER}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, 'A' || ok AS hakemus_oid, '{documents.TARGET}' || pk AS hakukohde_oid,
           CASE WHEN nr = 1 THEN ck % 2 = 0 END AS sora_terveys, CASE WHEN nr = 1 THEN true END AS sora_aiempi, enrolled AS tila,
           CASE WHEN nr = 1 AND o_orderstatus = 'O' THEN ck % 2 = 0 END AS kaksoistutkinto_kiinnostaa,
           CASE WHEN o_orderstatus = 'F' AND pk BETWEEN 100 AND 199 THEN true END AS urheilijatutkinto_kiinnostaa,
           CAST(NULL AS VARCHAR) AS harkinnanvaraisuuden_syy, CAST(NULL AS VARCHAR) AS pohjakoulutus, CAST(NULL AS VARCHAR) AS pohjakoulutus_nimi
    FROM valid LEFT JOIN enrolled USING (ck, pk) WHERE o_orderpriority >= '3'
    """
)
def mart_applicants_secondary(t: Source) -> DataFrame:
    """Answers about health, double degrees and athletes' degrees per choice."""
    (report,) = marts(t, "pub_fct_raportti_hakijat_toinen_aste")
    return report


SPRING_2025 = '{"type":"kausivuosi","koulutuksenAlkamisvuosi":2025,"koulutuksenAlkamiskausiKoodiUri":"kausi_k#1"}'
AUTUMN_2024 = '{"type":"kausivuosi","koulutuksenAlkamisvuosi":2024,"koulutuksenAlkamiskausiKoodiUri":"kausi_s#1"}'


@query(
    f"""
    WITH search AS (SELECT DISTINCT left(o_orderpriority, 1) AS nr, CASE WHEN o_orderpriority LIKE '1%' THEN '{AUTUMN_2024}' END AS own FROM orders),
    start AS (SELECT nr, coalesce(own, '{{"type":"eialkamiskautta"}}') AS s FROM search
              UNION SELECT nr, CASE WHEN p_size % 2 = 1 THEN '{SPRING_2025}' WHEN p_size % 10 = 0 THEN '{AUTUMN_2024}'
                               ELSE '{{"type":"eialkamiskautta"}}' END
              FROM search JOIN part ON CAST(p_size % 5 + 1 AS VARCHAR) = nr)
    SELECT 'H' || nr AS haku_oid, any_value('{{"en":"' || p || '","sv":"' || p || '","fi":"' || p || '"}}') AS haku_nimi, '[' || string_agg(s, ',' ORDER BY s) || ']' AS koulutuksen_alkamiskausi,
           CASE WHEN nr < '3' THEN 'korkeakoulu' ELSE 'toinen_aste' END AS haun_tyyppi
    FROM start JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders) ON left(p, 1) = nr GROUP BY nr
    """
)
def mart_search_seasons(t: Source) -> DataFrame:
    (report,) = marts(t, "pub_dim_kontrolli_haku")
    return report


@query(
    """
    WITH RECURSIVE tree AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS up FROM supplier),
    pairs AS (SELECT k AS a, k AS d FROM tree UNION ALL SELECT up, d FROM pairs JOIN tree ON k = a WHERE up IS NOT NULL)
    SELECT 'O' || a AS parent_oid, 'O' || d AS child_oid FROM pairs UNION ALL SELECT NULL, 'O' || k FROM tree
    """
)
def mart_organisation_tree(t: Source) -> DataFrame:
    (tree,) = marts(t, "pub_dim_organisaatio_rakenne")
    return tree


@query(
    """
    WITH office AS (SELECT CAST(left(CAST(s_suppkey AS VARCHAR), 1) AS BIGINT) AS institution FROM supplier WHERE s_suppkey >= 10)
    SELECT 'O' || s_suppkey AS organisaatio_oid, (SELECT count(*) FROM office WHERE institution = s_suppkey) AS offices, 3 AS parents,
           s_name AS name_fi, '["02"]' AS organisaatiotyypit
    FROM supplier WHERE s_suppkey BETWEEN 1 AND 9
    """
)
def mart_institution_offices(t: Source) -> DataFrame:
    """Institutions with the offices below them, found through ancestor lists."""
    (rows,) = marts(t, "pub_dim_oppilaitos_ja_toimipisteet")
    return rows.select(
        "organisaatio_oid", F.json_array_length("children").cast("bigint").alias("offices"),
        F.json_array_length("parent_oids").alias("parents"), F.get_json_object("organisaatio_nimi", "$.fi").alias("name_fi"),
        "organisaatiotyypit",
    )


@query(
    """
    WITH RECURSIVE names AS (
        SELECT s_suppkey AS k, s_name AS name, s_name AS own, CASE WHEN s_suppkey > 0 THEN s_suppkey END AS top FROM supplier WHERE s_suppkey < 10
        UNION ALL SELECT s_suppkey, CASE WHEN k < 10 THEN '' ELSE name || ', ' END || own || ', ' || s_name, s_name, top
        FROM names JOIN supplier ON s_suppkey // 10 = k AND s_suppkey >= 10)
    SELECT 'O' || k AS jarjestyspaikka_oid, name AS organisaatio_nimi, 'O' || top AS oppilaitos FROM names
    """
)
def mart_place_names(t: Source) -> DataFrame:
    """Places of study with the names and ids of the organisations above."""
    (names,) = marts(t, "int_organisaatio_hakukohteiden_nimet")
    return names.select(
        "jarjestyspaikka_oid", F.get_json_object("organisaatio_nimi", "$.fi").alias("organisaatio_nimi"), "oppilaitos"
    )


@query(
    """
    SELECT CAST(n_nationkey AS VARCHAR) AS kunta, CAST(r_regionkey AS VARCHAR) AS maakunta, n_name AS kunta_nimi, true AS viimeisin
    FROM nation JOIN region ON r_regionkey = n_regionkey
    """
)
def mart_code_sets(t: Source) -> DataFrame:
    """Municipalities related to provinces, with published names."""
    pairs, towns = marts(t, "pub_dim_koodisto_kunta_maakunta", "pub_dim_koodisto_kunta")
    named = towns.select("koodiarvo", "nimi_fi")
    return pairs.join(named, F.col("kunta_koodiarvo") == F.col("koodiarvo")).select(
        F.col("kunta_koodiarvo").alias("kunta"), F.col("maakunta_koodiarvo").alias("maakunta"),
        F.col("nimi_fi").alias("kunta_nimi"), F.col("viimeisin_versio").alias("viimeisin"),
    )


@query(
    """
    SELECT 'K' || kind AS koulutus_oid, CASE kind WHEN 0 THEN '60' ELSE '60-' || CAST(kind * 30 + 60 AS VARCHAR) END AS opintojenlaajuus,
           kind < 2 AS alempi_kk_aste, kind BETWEEN 2 AND 4 AS ylempi_kk_aste, kind = 5 AS jatkotutkinto, kind = 4 AS laakis,
           CAST(CASE WHEN kind < 2 THEN 1 WHEN kind < 5 THEN 2 ELSE 4 END AS INT) AS kk_tutkinnon_taso
    FROM (SELECT DISTINCT p_size % 6 AS kind FROM part)
    """
)
def mart_educations(t: Source) -> DataFrame:
    (rows,) = marts(t, "pub_dim_koulutus")
    return rows.select(
        "koulutus_oid", "opintojenlaajuus", "alempi_kk_aste", "ylempi_kk_aste", "jatkotutkinto", "laakis", "kk_tutkinnon_taso"
    )


@query(
    f"""
    SELECT 'R' || p_partkey // {documents.GROUP_SIZE} AS hakukohderyhma_oid, '{documents.TARGET}' || p_partkey AS hakukohde_oid,
           'H' || p_size % 5 + 1 AS haku_oid, md5('R' || p_partkey // {documents.GROUP_SIZE} || '-{documents.TARGET}' || p_partkey) AS hakukohderyhma_id
    FROM part
    """.replace("'H' || p_size % 5 + 1", "'H' || (p_size % 5 + 1)").replace(
        f"'R' || p_partkey // {documents.GROUP_SIZE}", f"'R' || (p_partkey // {documents.GROUP_SIZE})"
    )
)
def mart_target_groups(t: Source) -> DataFrame:
    (rows,) = marts(t, "pub_dim_hakukohderyhma_ja_hakukohteet")
    return rows


@query(
    f"""
    WITH {CHOICES}
    SELECT 'A' || ok AS hakemus_oid, '{documents.TARGET}' || pk AS hakukohde_id, 'J' || pk || '-' || sk AS valintatapajono_id, 'P' || ck AS henkilo_oid,
           CASE WHEN flag = 'R' THEN 'HYVAKSYTTY' WHEN flag = 'A' AND st = 'F' THEN 'VARASIJALTA_HYVAKSYTTY' WHEN flag = 'A' THEN 'VARALLA'
                WHEN st = 'F' THEN 'PERUNUT' ELSE 'HYLATTY' END AS valinnan_tila, sk % 5 = 0 AS hyvaksytty_harkinnanvaraisesti, ln AS jonosija
    FROM result
    """
)
def mart_register(t: Source) -> DataFrame:
    """Hand-over table of selection results joined to their queues."""
    (rows,) = marts(t, "gen_valintarekisteri")
    return rows.select(
        "hakemus_oid", F.col("hakukohde_oid").alias("hakukohde_id"), "valintatapajono_id", "henkilo_oid", "valinnan_tila",
        "hyvaksytty_harkinnanvaraisesti", "jonosija",
    )


@query(
    f"""
    WITH {CHOICES},
    answers AS (
        SELECT o_orderkey, unnest([
            {{'q': 'home-town', 'a': CAST(o_custkey % 25 AS VARCHAR)}}, {{'q': 'country-of-residence', 'a': '246'}},
            {{'q': 'gender', 'a': CASE WHEN o_custkey % 2 = 0 THEN 'mies' ELSE '2' END}}, {{'q': 'asiointikieli', 'a': '1'}},
            {{'q': 'nationality', 'a': '[["246"]]'}}, {{'q': 'higher-completed-base-education', 'a': '["pohjakoulutus_yo"]'}},
            {{'q': CASE WHEN o_orderstatus = 'O' THEN '{documents.DOUBLE}' END, 'a': 'x'}},
            {{'q': CASE WHEN o_orderstatus = 'F' THEN '{documents.ATHLETE}' END, 'a': '0'}},
            {{'q': CASE WHEN o_orderstatus = 'F' THEN '1dc3311d-2235-40d6-88d2-de2bd63e087b' END, 'a': '0'}},
            {{'q': CASE WHEN pk IS NOT NULL AND o_orderpriority >= '3' THEN 'sora-terveys_{documents.TARGET}' || pk END, 'a': CAST((o_custkey + 1) % 2 AS VARCHAR)}},
            {{'q': CASE WHEN pk IS NOT NULL AND o_orderpriority >= '3' THEN 'sora-aiempi_{documents.TARGET}' || pk END, 'a': '1'}},
            {{'q': CASE WHEN pk IS NOT NULL AND o_orderpriority >= '3' THEN 'sora-terveys' END, 'a': '0'}},
            {{'q': CASE WHEN pk IS NOT NULL AND o_orderstatus = 'O' THEN '{documents.DOUBLE}_{documents.TARGET}' || pk END, 'a': CAST(o_custkey % 2 AS VARCHAR)}}
        ]) AS x FROM orders LEFT JOIN (SELECT ok, pk FROM choice WHERE nr = 1) ON ok = o_orderkey)
    SELECT 'A' || o_orderkey AS hakemus_oid, x.q AS kysymys, x.a AS vastaus FROM answers WHERE x.q IS NOT NULL
    """
)
def mart_answers(t: Source) -> DataFrame:
    """Answers of applications as rows."""
    (rows,) = marts(t, "gen_hakemus_tieto")
    return rows.select("hakemus_oid", "kysymys", "vastaus")


@query(
    f"""
    WITH {CHOICES},
    earlier AS (SELECT o_orderkey AS ok FROM orders WHERE o_orderstatus = 'F'
                AND o_orderkey NOT IN (SELECT ok FROM choice WHERE pk = 0))
    SELECT 'A' || ok AS hakemus_oid, '{documents.TARGET}' || pk AS hakukohde_oid, nr AS hakutoivenumero,
           o_orderstatus = 'P' AND o_totalprice > 400000 AS poistettu FROM choice
    UNION ALL SELECT 'A' || ok, '{documents.TARGET}0', 1, true FROM earlier
    """
)
def mart_two_loads(t: Source) -> DataFrame:
    """Stored marts after two loads: choices that only the earlier version of
    an application listed are flagged as deleted."""
    tables = Tables(t.spark, work_path(t.spark, "marts"))
    loads = [
        (documents.first_versions(t), datetime(2024, 1, 1, 12)),
        (documents.applications(t), datetime(2024, 1, 2, 12)),
    ]
    for df, at in loads:
        run(tables, lambda name: df if name == "ataru_hakemus" else raw_defaults(t.spark, name), at, ["int_ataru_hakutoive"])
    return tables.read("int_ataru_hakutoive").select("hakemus_oid", "hakukohde_oid", "hakutoivenumero", "poistettu")


#: Rows of a table that are there twice, and their number in SQL.
TWICE = {
    "pub_dim_haku": ("haku_oid <= 'H2'", "SELECT count(DISTINCT left(o_orderpriority, 1)) FROM orders WHERE left(o_orderpriority, 1) <= '2'"),
    "pub_dim_koulutus": ("koulutus_oid = 'K1'", "SELECT count(DISTINCT p_size % 6) FROM part WHERE p_size % 6 = 1"),
    "pub_dim_toteutus": ("length(toteutus_oid) = 2", "SELECT count(DISTINCT p_size) FROM part WHERE p_size < 10"),
    "int_maksuvelvollisuus": ("maksuvelvollisuus = 'obligated'", "SELECT count(*) FROM choice WHERE nr = 1 AND o_custkey % 3 = 0"),
    "int_sijoitteluajo": ("false", "SELECT 0"),
}
#: Rows whose key is lost.
KEYLESS = {
    "pub_dim_haku": ("haku_oid = 'H5'", "SELECT count(DISTINCT left(o_orderpriority, 1)) FROM orders WHERE left(o_orderpriority, 1) = '5'"),
    "int_maksuvelvollisuus": ("maksuvelvollisuus <> 'obligated'", "SELECT count(*) FROM choice WHERE nr = 1 AND o_custkey % 3 <> 0"),
}


def _planted_sql() -> str:
    rows = [f"SELECT '{n}' AS model, 'unique' AS \"check\", CAST(({sql}) AS BIGINT) AS violations" for n, (_, sql) in TWICE.items()]
    rows += [f"SELECT '{n}', '{KEYS[n]} present', CAST(({KEYLESS[n][1] if n in KEYLESS else 'SELECT 0'}) AS BIGINT)" for n in TWICE]
    return f"WITH {CHOICES} " + " UNION ALL ".join(rows)


@query(_planted_sql())
def mart_checks(t: Source) -> DataFrame:
    """Declared checks of some tables, each in one pass, where rows are planted that
    break them: some are there twice, some have lost their key."""
    frames = []
    for name, df in zip(TWICE, marts(t, *TWICE)):
        key = KEYS[name]
        # twice out of one reading: a union would derive the model twice
        copies = F.when(F.expr(TWICE[name][0]), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        df = df.withColumn("_copy", F.explode(copies)).drop("_copy")
        if name in KEYLESS:
            df = df.withColumn(key, F.when(~F.expr(KEYLESS[name][0]), F.col(key)))
        frames.append(report(name, df, lambda other: marts(t, other)[0]).withColumn("model", F.lit(name)))
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first.select("model", "check", "violations")
