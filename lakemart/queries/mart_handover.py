"""Hand-over (gen) and published tables over the derived documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.queries import admission_documents as documents
from lakemart.queries.admissions import CHOICES, PERSON, REGISTER, STATE, marts
from lakemart.queries.registry import Source, query

EDUCATION = "CASE WHEN kind < 2 THEN '61111' || kind WHEN kind < 4 THEN '71111' || kind WHEN kind = 4 THEN '772101' ELSE '811111' END"
KINDS = "(SELECT DISTINCT p_size % 6 AS kind FROM part)"
FIELDS = "(SELECT DISTINCT p_size % 6 % 3 AS field FROM part)"
SETS = "(VALUES " + ", ".join(f"('{s}')" for s in documents.LEVEL_SETS) + ") AS s(code_set)"


@query(
    f"""
    WITH {CHOICES},
    listed AS (SELECT ok, '[' || string_agg('"{documents.TARGET}' || pk || '"', ',' ORDER BY nr) || ']' AS targets FROM choice GROUP BY ok)
    SELECT 'A' || o_orderkey AS hakemus_oid, '00000000-0000-0000-0000-000000000001' AS lomake_id, o_orderdate AS luotu,
           CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'inactivated' ELSE 'active' END AS tila, 'fi' AS kieli,
           'H' || left(o_orderpriority, 1) AS haku_oid, coalesce(targets, '[]') AS hakukohde, 'P' || o_custkey AS henkilo_oid,
           CAST(o_custkey % 25 AS VARCHAR) AS kotikunta, '246' AS asuinmaa, '["246"]' AS kansalaisuus,
           o_orderstatus = 'P' AND o_totalprice > 400000 AS poistettu, '["pohjakoulutus_yo"]' AS pohjakoulutus_kk
    FROM orders LEFT JOIN listed ON ok = o_orderkey
    """
)
def mart_handover_applications(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_hakemus")
    return rows.select(
        "hakemus_oid", "lomake_id", F.col("luotu").cast("timestamp_ntz").alias("luotu"), "tila", "kieli", "haku_oid", "hakukohde",
        "henkilo_oid", "kotikunta", "asuinmaa", "kansalaisuus", "poistettu", "pohjakoulutus_kk",
    )


@query(
    f"""
    WITH {CHOICES}, {REGISTER}
    SELECT 'H' || left(o_orderpriority, 1) AS haku_oid, md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, 'A' || ok AS hakemus_oid,
           '{documents.TARGET}' || pk AS hakukohde_oid, CASE WHEN o_orderpriority LIKE '5%' THEN -1 ELSE nr END AS hakutoivenumero,
           taken AS vastaanottotieto, enrolled AS ilmoittautumisen_tila, {STATE} AS valintatieto, flag = 'R' AND sk % 2 = 0 AS ehdollisesti_hyvaksytty,
           ck % 4 = 0 AS ensikertalainen
    FROM valid LEFT JOIN taken USING (ck, pk) LEFT JOIN enrolled USING (ck, pk)
    """
)
def mart_handover_choices(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_hakutoive")
    return rows.select(
        "haku_oid", "hakutoive_id", "hakemus_oid", "hakukohde_oid", "hakutoivenumero", "vastaanottotieto", "ilmoittautumisen_tila",
        "valintatieto", "ehdollisesti_hyvaksytty", "ensikertalainen",
    )


@query(
    f"""
    WITH {PERSON}
    SELECT 'P' || ck AS henkilo_oid, 'P' || master AS oppijanumero, ck = master AS on_master, c_name AS etunimet, c_mktsegment AS sukunimi,
           CAST(c_nationkey AS VARCHAR) AS kotikunta, CAST(ck % 2 + 1 AS INT) AS sukupuoli, false AS turvakielto, true AS yksiloityvtj
    FROM person JOIN customer ON c_custkey = ck
    """
)
def mart_handover_persons(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_henkilo")
    return rows.select(
        "henkilo_oid", "oppijanumero", "on_master", "etunimet", "sukunimi", "kotikunta", F.col("sukupuoli").cast("int").alias("sukupuoli"),
        "turvakielto", "yksiloityvtj",
    )


@query(
    f"""
    SELECT 'target' AS kind, '{documents.TARGET}' || p_partkey AS oid, 'T' || p_size AS upper_oid, p_name AS name, CAST(p_size AS VARCHAR) AS detail FROM part
    UNION ALL SELECT DISTINCT 'offer', 'T' || p_size, 'K' || p_size % 6, 'offer ' || p_size,
           '["oppilaitoksenopetuskieli_2#1","oppilaitoksenopetuskieli_1#1"]' FROM part
    UNION ALL SELECT 'education', 'K' || kind, NULL, 'education ' || kind, '["koulutus_' || {EDUCATION} || '#1"]' FROM {KINDS}
    UNION ALL SELECT DISTINCT 'search', 'H' || left(o_orderpriority, 1), NULL, o_orderpriority,
           CASE WHEN left(o_orderpriority, 1) <= '2' THEN 'haunkohdejoukko_12#1' ELSE 'haunkohdejoukko_11#1' END FROM orders
    """
)
def mart_handover_offers(t: Source) -> DataFrame:
    """Targets, offers, educations and searches as they are handed over."""
    targets, offers, educations, searches = marts(t, "gen_hakukohde", "gen_toteutus", "gen_koulutus", "gen_haku")

    def shown(df: DataFrame, kind: str, oid: str, upper, name: str, detail: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), F.col(oid).alias("oid"), (F.col(upper) if upper else F.lit(None).cast("string")).alias("upper_oid"),
            F.col(name).alias("name"), F.col(detail).cast("string").alias("detail"),
        )

    return (
        shown(targets, "target", "hakukohde_oid", "toteutus_oid", "hakukohde_nimi_fi", "aloituspaikat")
        .unionByName(shown(offers, "offer", "toteutus_oid", "koulutus_oid", "toteutus_nimi_fi", "opetuskieli_koodiurit"))
        .unionByName(shown(educations, "education", "koulutus_oid", None, "koulutus_nimi_fi", "koulutukset_koodiuri"))
        .unionByName(shown(searches, "search", "haku_oid", None, "haku_nimi_fi", "kohdejoukko_koodiuri"))
    )


@query(
    f"""
    WITH codes AS (
        SELECT 'kunta' AS code_set, CAST(n_nationkey AS VARCHAR) AS value, n_name AS name FROM nation
        UNION ALL SELECT 'maakunta', CAST(r_regionkey AS VARCHAR), r_name FROM region
        UNION ALL SELECT 'koulutus', {EDUCATION}, 'kind ' || kind FROM {KINDS}
        UNION ALL SELECT 'maatjavaltiot2', c, 'country ' || c FROM (VALUES ('246'), ('752'), ('840')) AS x(c)
        UNION ALL SELECT 'valtioryhmat', 'EU', 'EU'
        UNION ALL SELECT code_set, CAST(field AS VARCHAR), 'field ' || field FROM {FIELDS}, {SETS}
        UNION ALL SELECT 'organisaatiotyyppi', '0' || r_regionkey, 'type ' || r_regionkey FROM region WHERE r_regionkey BETWEEN 1 AND 3)
    SELECT code_set || '_' || value || '#1' AS versioitu_koodiuri, code_set AS koodistouri, value AS koodiarvo, name AS nimi_fi, 'LUONNOS' AS tila FROM codes
    """
)
def mart_handover_codes(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_koodi")
    return rows.select("versioitu_koodiuri", "koodistouri", "koodiarvo", "nimi_fi", "tila")


@query(
    f"""
    SELECT 'maakunta_' || n_regionkey AS alakoodiuri, 'kunta_' || n_nationkey AS ylakoodiuri, 'SISALTYY' AS relaatiotyyppi FROM nation
    UNION ALL SELECT 'valtioryhmat_EU', 'maatjavaltiot2_752', 'SISALTYY'
    UNION ALL SELECT code_set || '_' || kind % 3, 'koulutus_' || {EDUCATION}, 'SISALTYY' FROM {KINDS}, {SETS}
    """
)
def mart_handover_relations(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_koodirelaatio")
    return rows.select("alakoodiuri", "ylakoodiuri", "relaatiotyyppi")


@query(
    """
    SELECT 'O' || s_suppkey AS organisaatio_oid, s_name AS nimi_fi, 'AKTIIVINEN' AS tila, 'kunta_' || s_nationkey AS sijaintikunta,
           CASE WHEN s_suppkey = 0 THEN '["organisaatiotyyppi_01"]' WHEN s_suppkey < 10 THEN '["organisaatiotyyppi_02"]'
                ELSE '["organisaatiotyyppi_03"]' END AS organisaatiotyypit, '["oppilaitoksenopetuskieli_1#1"]' AS opetuskielet
    FROM supplier
    """
)
def mart_handover_organisations(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_organisaatio")
    return rows.select("organisaatio_oid", "nimi_fi", "tila", "sijaintikunta", "organisaatiotyypit", "opetuskielet")


@query(
    f"""
    SELECT DISTINCT 'J' || l_partkey || '-' || l_suppkey AS valintatapajono_id, s_name AS valintatapajono_nimi,
           '{documents.TARGET}' || l_partkey AS hakukohde_oid, CAST(s_nationkey AS INT) AS prioriteetti
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
    """
)
def mart_handover_queues(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_valintarekisteri_valintatapajono")
    return rows.select("valintatapajono_id", "valintatapajono_nimi", "hakukohde_oid", F.col("prioriteetti").cast("int").alias("prioriteetti"))


@query(
    """
    SELECT 'A' || o_orderkey AS hakemus_oid, 'H' || left(o_orderpriority, 1) AS haku_oid, 'active' AS tila, 'P' || o_custkey AS henkilo_oid,
           '["pohjakoulutus_yo"]' AS pohjakoulutus_kk
    FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice > 400000)
    """
)
def mart_published_applications(t: Source) -> DataFrame:
    (rows,) = marts(t, "pub_fct_hakemus")
    return rows.select("hakemus_oid", "haku_oid", "tila", "henkilo_oid", "pohjakoulutus_kk")


@query(
    f"""
    WITH {CHOICES}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, '{documents.TARGET}' || pk AS hakukohde_oid, 'J' || pk || '-' || sk AS valintatapajono_oid,
           'A' || ok AS hakemus_oid, 'P' || ck AS henkilo_oid,
           CASE WHEN flag = 'R' THEN 'HYVAKSYTTY' WHEN flag = 'A' AND st = 'F' THEN 'VARASIJALTA_HYVAKSYTTY' WHEN flag = 'A' THEN 'VARALLA'
                WHEN st = 'F' THEN 'PERUNUT' ELSE 'HYLATTY' END AS valinnan_tila, sk % 2 = 0 AS ehdollisesti_hyvaksyttavissa,
           strftime(make_timestamp((1704067200 + ok) * 1000000), '%Y-%m-%d') AS paiva
    FROM result
    """
)
def mart_published_results(t: Source) -> DataFrame:
    (rows,) = marts(t, "pub_dim_valinnantulos")
    return rows.select(
        "hakutoive_id", "hakukohde_oid", "valintatapajono_oid", "hakemus_oid", "henkilo_oid", "valinnan_tila", "ehdollisesti_hyvaksyttavissa",
        F.date_format("valintatiedon_pvm", "yyyy-MM-dd").alias("paiva"),
    )


@query(
    f"""
    SELECT 'maakunta' AS dimension, 'maakunta_' || r_regionkey || '#1' AS versioitu_koodiuri, CAST(r_regionkey AS VARCHAR) AS koodiarvo, r_name AS nimi_fi FROM region
    UNION ALL SELECT 'koulutus', 'koulutus_' || {EDUCATION} || '#1', {EDUCATION}, 'kind ' || kind FROM {KINDS}
    UNION ALL SELECT 'organisaatiotyyppi', 'organisaatiotyyppi_0' || r_regionkey || '#1', '0' || r_regionkey, 'type ' || r_regionkey FROM region WHERE r_regionkey BETWEEN 1 AND 3
    """
)
def mart_code_dimensions(t: Source) -> DataFrame:
    names = ("maakunta", "koulutus", "organisaatiotyyppi", "kausi", "kieli", "posti", "sukupuoli", "yokokeet", "arvosana", "hakutyyppi")
    frames = [
        df.select(F.lit(n).alias("dimension"), "versioitu_koodiuri", F.col("koodiarvo").cast("string").alias("koodiarvo"), "nimi_fi")
        for n, df in zip(names, marts(t, *[f"pub_dim_koodisto_{n}" for n in names]))
    ]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


@query(
    """
    WITH s AS (SELECT DISTINCT left(o_orderpriority, 1) AS nr FROM orders)
    SELECT 'H' || nr AS haku_oid, 'PH_OPVP' AS avain, '{"date":1720796400000}' AS alkuperainen_arvo, TIMESTAMP '2024-07-12 15:00:00' AS aikaleima FROM s
    UNION ALL SELECT 'H' || nr, 'PH_HPVOA', '{"value":14}', NULL FROM s
    UNION ALL SELECT 'H' || nr, 'jarjestetytHakutoiveet', CASE WHEN nr = '5' THEN 'false' ELSE 'true' END, NULL FROM s
    """
)
def mart_handover_parameters(t: Source) -> DataFrame:
    (rows,) = marts(t, "gen_ohjausparametri_haku")
    return rows.select("haku_oid", "avain", "alkuperainen_arvo", F.col("aikaleima").cast("timestamp_ntz").alias("aikaleima"))


@query(
    f"""
    WITH {PERSON}
    SELECT 'P' || ck AS oppija_oid, 'P' || master AS master_oid, o.c_name AS etunimet, o.c_mktsegment AS sukunimi,
           CAST(ck % 2 + 1 AS VARCHAR) AS sukupuoli, CAST(o.c_nationkey AS VARCHAR) AS kotikunta, n_name AS kotikunta_fi
    FROM person JOIN customer o ON o.c_custkey = ck JOIN nation ON n_nationkey = o.c_nationkey
    """
)
def mart_published_learners(t: Source) -> DataFrame:
    (rows,) = marts(t, "pub_dim_oppija_henkilo")
    return rows.select("oppija_oid", "master_oid", "etunimet", "sukunimi", F.col("sukupuoli").cast("string").alias("sukupuoli"), "kotikunta", "kotikunta_fi")


@query(
    """
    WITH tree AS (SELECT s_suppkey AS k, s_name AS name, CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS up FROM supplier)
    SELECT 'O' || p.k AS provider, p.name AS provider_name, 'O' || c.k AS institution, c.name AS institution_name
    FROM tree p JOIN tree c ON c.up = p.k WHERE p.k = 0
    """
)
def mart_published_providers(t: Source) -> DataFrame:
    """Providers with their institutions, out of the nested documents."""
    (rows,) = marts(t, "pub_dim_koulutustoimija_ja_toimipisteet")
    child = F.from_json("children", "array<struct<organisaatio_oid:string,organisaatio_nimi:struct<fi:string>>>")
    return rows.withColumn("c", F.explode(child)).select(
        F.col("organisaatio_oid").alias("provider"), F.get_json_object("organisaatio_nimi", "$.fi").alias("provider_name"),
        F.col("c.organisaatio_oid").alias("institution"), F.col("c.organisaatio_nimi.fi").alias("institution_name"),
    )


@query(
    f"""
    SELECT 'group' AS kind, 'R' || nr AS id, 'group ' || nr AS value FROM (SELECT DISTINCT p_partkey // {documents.GROUP_SIZE} AS nr FROM part)
    UNION ALL SELECT 'field', 'koulutus_' || {EDUCATION}, CAST(kind % 3 AS VARCHAR) FROM {KINDS}
    UNION ALL SELECT 'country', 'maatjavaltiot2_' || c, 'country ' || c FROM (VALUES ('246'), ('752'), ('840')) AS x(c)
    UNION ALL SELECT 'union', 'maatjavaltiot2_752', 'EU' FROM region WHERE r_regionkey = 0
    """
)
def mart_published_groups(t: Source) -> DataFrame:
    """Groups of targets, fields of education, countries and their unions."""
    groups, fields, countries, unions = marts(
        t, "pub_dim_hakukohderyhma", "pub_dim_koodisto_koulutus_alat_ja_asteet", "pub_dim_koodisto_maa_2", "pub_dim_koodisto_maa_valtioryhma"
    )

    def shown(df: DataFrame, kind: str, key: str, value) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), value.cast("string").alias("value"))

    return (
        shown(groups, "group", "hakukohderyhma_oid", F.get_json_object("hakukohderyhma_nimi", "$.fi"))
        .unionByName(shown(fields, "field", "koodiuri", F.col("kansallinenkoulutusluokitus2016koulutusalataso1")))
        .unionByName(shown(countries, "country", "koodiuri", F.col("nimi_fi")))
        .unionByName(shown(unions, "union", "maa_koodiuri", F.col("valtioryhma_koodiarvo")))
    )


@query(
    """
    SELECT 'S' || o_orderkey AS resourceid, 'O' || o_custkey % 100 AS myontaja, CASE WHEN o_orderstatus = 'F' THEN 'VALMIS' ELSE 'KESKEN' END AS tila,
           strftime(o_orderdate, '%Y-%m-%d') AS paiva, 'P' || o_custkey AS henkilo_oid, o_orderpriority LIKE '5%' AS poistettu, true AS vahvistettu
    FROM orders
    """
)
def mart_achievements(t: Source) -> DataFrame:
    """Newest versions of examinations."""
    (rows,) = marts(t, "int_sure_suoritus")
    return rows.select(
        "resourceid", "myontaja", "tila", F.date_format("valmistuminen", "yyyy-MM-dd").alias("paiva"), "henkilo_oid", "poistettu", "vahvistettu"
    )


GRADE = f"""
    grade AS (SELECT 'G' || ok || '-' || pk AS resourceid, ok, ck, ln, st, [{", ".join(f"'{g}'" for g in documents.GRADES)}][sk % 7 + 1] AS arvosana,
                     CASE WHEN flag = 'N' THEN '4-10' ELSE 'YO' END AS asteikko, CASE WHEN sk % 4 = 0 THEN 'XXX' ELSE 'K' || pk % 10 END AS yo_aine,
                     o_orderpriority
              FROM result WHERE st <> 'F')
"""


@query(f"WITH {CHOICES}, {GRADE} SELECT resourceid, 'S' || ok AS suoritus, arvosana, asteikko, yo_aine FROM grade")
def mart_grades(t: Source) -> DataFrame:
    """Grades that are not deleted, with the code of their subject."""
    (rows,) = marts(t, "int_sure_arvosana")
    return rows.select("resourceid", "suoritus", "arvosana", "asteikko", "yo_aine")


@query(
    f"""
    WITH {CHOICES}, {GRADE},
    last AS (SELECT ok, ck, yo_aine, arg_max(arvosana, (ln, resourceid)) AS arvosana FROM grade
             WHERE asteikko = 'YO' AND o_orderpriority NOT LIKE '5%' GROUP BY 1, 2, 3)
    SELECT DISTINCT 'P' || ck AS henkilo_oid, yo_aine, arvosana FROM last
    """
)
def mart_matriculation(t: Source) -> DataFrame:
    """Last matriculation grade of each subject of an examination, as rows."""
    (rows,) = marts(t, "int_arvosana_yo")
    grades = F.explode(F.from_json("arvosanat", "map<string,string>"))
    return rows.select("henkilo_oid", grades.alias("yo_aine", "arvosana")).distinct()


@query(
    """
    SELECT 'E' || c_custkey AS resourceid, 'P' || c_custkey AS henkilooid, c_mktsegment AS komo, 'O' || c_custkey % 10 AS myontaja, c_acctbal < 0 AS poistettu
    FROM customer
    """
)
def mart_study_rights(t: Source) -> DataFrame:
    (rows,) = marts(t, "int_sure_opiskeluoikeus")
    return rows.select("resourceid", "henkilooid", "komo", "myontaja", "poistettu")
