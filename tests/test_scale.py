"""Plans and settings that hold at size: what must not be broadcast, zipped or written twice."""

import hashlib

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from lakemart.functions.keys import NULL_TEXT, surrogate_key
from lakemart.operators import latest, merge
from lakemart.plans.catalog import MODELS
from lakemart.plans.dw import current
from lakemart.queries import admissions
from lakemart.queries.registry import QUERIES, Source
from tests.oracle import BASE

FOLDER = f"{BASE}/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_into_a_merged_table_that_is_shuffled_by_the_key(spark, rows):
    events = rows([(u, n, d) for n, (u, d) in enumerate([(1, 3), (2, 3), (1, 1), (3, 1), (2, 2), (3, 2), (4, 2), (None, 1)])], "user long, id long, day int")
    state = latest.newest_per_key(events.filter("day = 3"), ["user"], "day", "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for day in (1, 2):
            batch = latest.newest_per_key(events.filter(F.col("day") == day), ["user"], "day", "id")
            state = merge.upsert(state, merge.only_newer(batch, state, ["user"], "day"), ["user"])
        assert {tuple(r) for r in state.collect()} == {(1, 0, 3), (2, 1, 3), (3, 5, 2), (4, 6, 2), (None, 7, 1)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_columns_read_out_of_variants_are_not_broadcast(spark):
    assert "Broadcast" not in plan_of(QUERIES["shred_variants"](spark, FOLDER))


def test_newest_version_out_of_the_history_takes_one_shuffle(spark, rows):
    """Copies of versions, with NULL times and keys: one shuffle by the object, not one by version and one by object."""
    data = [("a", 1, 1, "f", 1), ("a", 1, 2, "f", 1), ("a", 2, 1, "f", 1), ("a", 2, 1, "f", 2), ("b", None, 1, "f", 1), ("b", 3, 9, "f", 1), (None, 1, 1, "f", 1), (None, 1, 1, "g", 1)]
    stage = rows(data, "oid string, muokattu int, dw_metadata_dbt_copied_at int, dw_metadata_filename string, dw_metadata_file_row_number int")
    history = MODELS["dw_kouta_hakukohde"].build(stage, F.lit("2024-01-01"))
    newest = current(history, "oid")
    assert {tuple(r)[:5] for r in newest.collect()} == {("a", 2, 1, "f", 2), ("b", None, 1, "f", 1), (None, 1, 1, "g", 1)}
    assert history.count() == 5
    assert plan_of(newest.select("*")).count("Exchange") == 1


def test_results_meet_places_by_the_parts_of_their_keys(spark, rows):
    """NULL parts meet NULL parts; no digest is shuffled."""
    parts = [("A1", "H1", "J1"), ("A1", "H1", "J2"), ("A2", "H1", None), ("A3", None, "J1")]
    flag, text = F.lit(False), F.lit(None).cast("string")
    keyed = rows(parts, "hakemus_oid string, hakukohde_oid string, valintatapajono_oid string").withColumns({
        "hakutoive_id": surrogate_key("hakemus_oid", "hakukohde_oid"), "hakemus_hakukohde_valintatapa_id": surrogate_key("hakemus_oid", "hakukohde_oid", "valintatapajono_oid")})
    results = keyed.withColumns({
        "valinnantulos_id": F.col("hakemus_hakukohde_valintatapa_id"), "henkilo_oid": F.lit("P1"), "valinnan_tila": F.lit("HYVAKSYTTY"), "ehdollisesti_hyvaksyttavissa": flag,
        "ehdollisen_hyvaksymisen_ehto": text, "valinnantilan_kuvauksen_teksti": text, "julkaistavissa": flag, "hyvaksyperuuntunut": flag, "valintatiedon_pvm": F.lit("2024-01-01").cast("date")})
    places = keyed.withColumns({
        "jonosija_id": F.col("hakemus_hakukohde_valintatapa_id"), "hyvaksytty_harkinnanvaraisesti": F.col("hakemus_oid") != "A1", "jonosija": F.lit(3), "varasijan_numero": F.lit(0),
        "onko_muuttunut_viime_sijoittelussa": flag, "prioriteetti": F.lit(1), "pisteet": F.lit(1.5), "siirtynyt_toisesta_valintatapajonosta": flag, "sijoitteluajo_id": F.lit("1")})
    queues = rows([("J1", "first", 1), ("J2", "second", 2)], "valintatapajono_oid string, valintatapajono_nimi string, prioriteetti int")
    built = MODELS["int_hakutoive_valintatapajono"].build(results, places, queues)
    found = built.select("hakutoive_id", "valintatieto", F.json_array_length("valintatapajonot")).collect()
    md5 = lambda *p: hashlib.md5("-".join(x or NULL_TEXT for x in p).encode()).hexdigest()
    discretion = "HARKINNANVARAISESTI_HYVAKSYTTY"
    assert {tuple(r) for r in found} == {(md5("A1", "H1"), "HYVAKSYTTY", 2), (md5("A2", "H1"), discretion, 1), (md5("A3", None), discretion, 1)}
    shuffles = [line for line in plan_of(built).splitlines() if "Exchange hashpartitioning(" in line]
    assert not any("hakutoive_id" in line or "hashpartitioning(hakemus_hakukohde" in line for line in shuffles)


def test_wide_choices_are_stored_for_several_readers_only(spark):
    stored = lambda: set().union(*admissions.STORED.values())
    kept = dict(admissions.STORED)
    admissions.forget()
    try:
        admissions.marts(Source(spark, FOLDER), "int_hakutoive")
        assert "int_ataru_hakemus" in stored() and "int_hakutoive" not in stored()
    finally:
        admissions.forget()
        admissions.STORED.update(kept)


def test_applications_are_stored_for_several_readings_only(spark):
    """A mart that reads them once takes its columns without writing whole documents; choices of
    which two readings lead to them have them stored."""
    stored = lambda: set().union(*admissions.STORED.values())
    kept = dict(admissions.STORED)
    admissions.forget()
    try:
        for model in ("pub_fct_hakemus", "pub_dim_henkilo", "int_ataru_hakutoive", "int_maksuvelvollisuus", "int_sijoitteluajo"):
            (found,) = admissions.marts(Source(spark, FOLDER), model)
            assert not stored() & {"int_ataru_hakemus", "stg_valintarekisteri_jonosija"}, model
            assert found.count() > 0
        admissions.marts(Source(spark, FOLDER), "pub_fct_hakemus", "int_maksuvelvollisuus")
        assert "int_ataru_hakemus" in stored()
        admissions.marts(Source(spark, FOLDER), "dw_valintarekisteri_jonosija")
        assert "stg_valintarekisteri_jonosija" in stored()
    finally:
        admissions.STORED.clear()
        admissions.STORED.update(kept)


def test_planted_rows_come_out_of_one_reading(spark):
    admissions.forget()
    plan = QUERIES["mart_checks"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderstatus") and plan.count("collect_set") == 1
