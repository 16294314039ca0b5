import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.plans.catalog import MODELS, evaluate, in_order, raw_defaults, raw_tables, run
from lakemart.sinks.versions import Tables
from tests import documents as d

WANTED = [
    "int_ataru_hakutoive", "int_hakemus_tiedot", "gen_hakemus", "gen_hakemus_tieto", "int_arvosana_yo", "int_onr_kansalaisuus",
    "int_sure_suoritus", "int_supa_ensikertalainen", "int_valintalaskenta_pistetieto", "int_ataru_soratietoja",
    "int_valintaperusteet_aloituspaikat", "int_valintaperusteet_valintakoe", "gen_valinnanvaihe", "int_vastaanotto",
    "int_hakutoive_osallistuminen", "gen_ohjausparametri_haku", "int_ohjausparametrit_parameter", "int_onr_kansalaisuus_nimi",
]


def sources(spark, *deliveries):
    tables = {}
    for documents, at in deliveries:
        for name, docs in documents.items():
            df = d.raw(spark, name, docs, at)
            tables[name] = tables[name].unionByName(df) if name in tables else df
    return lambda name: tables[name] if name in tables else raw_defaults(spark, name)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Marts after two loads."""
    tables = Tables(spark, str(tmp_path_factory.mktemp("marts")))
    run(tables, sources(spark, (d.FIRST, d.FIRST_AT)), datetime(2024, 1, 10, 13), WANTED)
    both = sources(spark, (d.FIRST, d.FIRST_AT), (d.SECOND, d.SECOND_AT))
    run(tables, both, datetime(2024, 2, 10, 13), WANTED)
    return tables


@pytest.fixture(scope="module")
def rebuilt(spark):
    """The same documents in one full refresh."""
    both = sources(spark, (d.FIRST, d.FIRST_AT), (d.SECOND, d.SECOND_AT))
    return evaluate(both, WANTED, F.lit("2024-02-10 13:00:00").cast("timestamp"))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_every_raw_table_has_a_stage_and_every_input_exists():
    sources_and_seeds = set(raw_tables()) | {"raw_haunkohdejoukko", "int_sure_haut"}
    assert len(raw_tables()) == 46
    for m in MODELS.values():
        assert set(m.tables) <= set(MODELS) | sources_and_seeds, m.name
    order = in_order()
    assert len(order) == len(MODELS) and all(
        order.index(t) < order.index(n) for n in order for t in MODELS[n].tables if t in MODELS
    )


def test_stage_appends_only_new_documents(loaded):
    assert loaded.read("stg_ataru_hakemus").count() == 7


def test_history_holds_one_row_per_version(loaded):
    assert rows(loaded.read("dw_ataru_hakemus"), "oid", "versio_id") == [("A1", 1), ("A1", 2), ("A2", 4), ("A2", 5), ("A3", 1), ("A4", 1)]


def test_late_older_version_does_not_win(loaded):
    assert rows(loaded.read("int_ataru_hakemus"), "hakemus_oid", "versio_id", "poistettu") == [
        ("A1", 2, False), ("A2", 5, False), ("A4", 1, True),
    ]


def test_application_details(loaded):
    a1 = loaded.read("int_ataru_hakemus").filter("hakemus_oid = 'A1'").first()
    assert a1.sukupuoli is None and a1.asiointikieli is None and a1.sahkoinenviestintalupa is True
    assert a1.pohjakoulutuksen_maa_toinen_aste == "246"
    assert json.loads(a1.pohjakoulutus_kk) == ["pohjakoulutus_yo"]
    assert json.loads(a1.pohjakoulutus_kk_valmistumisvuosi) == {"pohjakoulutus_yo--yes-year-of-completion": "2001"}


def test_dropped_choice_is_flagged(loaded):
    choices = loaded.read("int_ataru_hakutoive").filter("hakemus_oid = 'A1'")
    assert rows(choices, "hakukohde_oid", "hakutoivenumero", "poistettu") == [(d.T1, 1, True), (d.T2, 1, False)]


def test_older_change_time_does_not_replace_state(loaded):
    assert rows(loaded.read("int_sure_suoritus"), "resourceid", "poistettu") == [("S1", False), ("S2", True)]


def test_scores_take_the_newer_value(loaded):
    assert rows(loaded.read("int_valintalaskenta_pistetieto"), "hakemus_oid", "arvo") == [("A1", "9")]


def test_rows_of_inactive_applications_are_purged(loaded):
    assert rows(loaded.read("int_supa_ensikertalainen"), "hakemus_oid") == [("A1",), ("A2",)]


def test_grades_per_person(loaded):
    ((person, grades),) = rows(loaded.read("int_arvosana_yo"), "henkilo_oid", "arvosanat")
    assert person == "P1" and json.loads(grades) == {"EA": "L", "M": "E", "C_XX": "M", "XXX": "A"}


def test_citizenship_priority_and_empty_list(loaded):
    assert rows(loaded.read("int_onr_kansalaisuus"), "henkilo_oid", "kansalaisuus", "priorisoitu_kansalaisuus") == [
        ("P1", "246", True), ("P1", "752", False),
    ]
    assert rows(loaded.read("int_onr_kansalaisuus_nimi"), "henkilo_oid", "kansalaisuudet_nimi") == [
        ("P1", "[null,null]"), ("P2", "[null]"),
    ]


def test_health_answers_match_choices(rebuilt):
    got = rows(rebuilt["int_ataru_soratietoja"], "hakemus_oid", "hakukohde_oid", "sora_terveys", "sora_aiempi")
    assert got == []


def test_health_answers_of_the_first_version(spark):
    first = evaluate(sources(spark, (d.FIRST, d.FIRST_AT)), ["int_ataru_soratietoja"], F.lit("2024-02-10").cast("timestamp"))
    got = rows(first["int_ataru_soratietoja"], "hakemus_oid", "hakukohde_oid", "sora_terveys", "sora_aiempi")
    assert got == [("A1", d.T1, True, False)]


def test_study_places_of_allocated_queues(loaded):
    assert rows(loaded.read("int_valintaperusteet_aloituspaikat"), "hakukohde_oid", "aloituspaikat") == [(d.T1, 9)]
    assert rows(loaded.read("int_valintaperusteet_valintakoe"), "valintakoe_id", "valintakoe_aktiivinen") == [("K1", True)]
    assert rows(loaded.read("gen_valinnanvaihe"), "valinnanvaihe_id") == [("V1",), ("V2",)]


def test_withdrawn_answer_does_not_count(loaded):
    assert rows(loaded.read("int_vastaanotto"), "vastaanottotieto") == [("VASTAANOTTANUT_SITOVASTI",)]


def test_narrow_space_in_times(loaded):
    assert rows(loaded.read("int_valintalaskenta_valintakoe_osallistuminen"), "muokattu") == [(datetime(2024, 11, 5, 9, 15, 2),)]
    assert rows(loaded.read("int_hakutoive_osallistuminen"), "hakemus_oid", "osallistuminen") == [("A1", "OSALLISTUI")]


def test_parameters(loaded):
    assert rows(loaded.read("int_ohjausparametrit_parameter"), "vastaanotto_paattyy", "jarjestetyt_hakutoiveet") == [
        (datetime(2024, 7, 12, 15), False)
    ]
    long = rows(loaded.read("gen_ohjausparametri_haku"), "avain", "aikaleima", "aikaleima_alkaa")
    assert long == [("PH_OPVP", datetime(2024, 7, 12, 15), None), ("PH_X", None, datetime(2024, 1, 1)), ("jarjestetytHakutoiveet", None, None)]


# choices that are gone leave a flag, and their answers a row, only where loads are told apart
@pytest.mark.parametrize("name", [n for n in WANTED if n not in ("int_ataru_hakutoive", "int_ataru_soratietoja")])
def test_two_loads_equal_one_refresh(loaded, rebuilt, name):
    stamps = {"dw_metadata_stg_stored_at", "dw_metadata_dw_stored_at"}
    columns = [c for c in rebuilt[name].columns if c not in stamps]
    assert sorted(columns) == sorted(c for c in loaded.read(name).columns if c not in stamps)
    assert rows(loaded.read(name), *columns) == rows(rebuilt[name], *columns)


def test_a_run_without_news_changes_nothing(spark, loaded):
    both = sources(spark, (d.FIRST, d.FIRST_AT), (d.SECOND, d.SECOND_AT))
    names = ["int_ataru_hakutoive", "gen_hakemus", "int_valintalaskenta_pistetieto"]
    before = {n: rows(loaded.read(n), *loaded.read(n).columns) for n in names}
    run(loaded, both, datetime(2024, 2, 10, 14), names)
    after = {n: rows(loaded.read(n), *loaded.read(n).columns) for n in names}
    assert before == after


def test_failed_check_stops_the_run(spark, tmp_path):
    from lakemart.plans.checks import ChecksFailed, require

    twice = {"valintarekisteri_valintatapajono": [{"oid": "J1", "hakukohdeOid": "T1"}, {"oid": "J1", "hakukohdeOid": "T2"}]}
    tables = Tables(spark, str(tmp_path))
    wanted = ["gen_valintarekisteri_valintatapajono"]
    with pytest.raises(ChecksFailed, match="gen_valintarekisteri_valintatapajono: unique"):
        run(tables, sources(spark, (twice, d.FIRST_AT)), datetime(2024, 1, 10, 13), wanted, check=require)


def test_checks_name_existing_columns(rebuilt):
    from lakemart.plans import checks

    assert set(checks.KEYS) | set(checks.REQUIRED) | set(checks.TOGETHER) <= set(MODELS)
    for name, df in rebuilt.items():
        checks.violations(name, df, lambda other: rebuilt[other])


def test_published_columns_stay(spark, tmp_path):
    from lakemart.operators.quality import ContractBroken

    tables = Tables(spark, str(tmp_path))
    tables.write("pub_dim_maksuvelvollisuus", spark.createDataFrame([("x",)], "hakutoive_id string"))
    with pytest.raises(ContractBroken):
        run(tables, sources(spark), datetime(2024, 1, 10, 13), ["pub_dim_maksuvelvollisuus"])


def test_declared_types_hold_before_the_first_publish(spark, tmp_path):
    from lakemart.operators.quality import ContractBroken
    from lakemart.plans import contracts, model

    assert len(contracts.TABLES) == 27 and set(contracts.TABLES) <= set(MODELS)
    built = evaluate(sources(spark), contracts.TABLES, F.lit("2024-02-10").cast("timestamp"))
    for name in contracts.TABLES:
        contracts.keep(name, built[name])
    assert contracts.contract("pub_dim_haku", ["haku_oid", "hakukohteiden_priorisointi"]).simpleString() == "struct<haku_oid:string,hakukohteiden_priorisointi:boolean>"
    found = {}
    saved, model.MODELS = model.MODELS, found
    try:
        model.add("pub_dim_maksuvelvollisuus", lambda src: src, ("src",))
    finally:
        model.MODELS = saved
    wrong = spark.createDataFrame([(1, "x")], "hakutoive_id int, maksuvelvollisuus string")
    with pytest.raises(ContractBroken, match="hakutoive_id is int, not string"):
        run(Tables(spark, str(tmp_path)), lambda name: wrong, datetime(2024, 1, 1), ["pub_dim_maksuvelvollisuus"], models=found)


def test_history_rewrites_only_months_with_news(loaded):
    from pathlib import Path

    folder = Path(loaded.folder("dw_ataru_hakemus").removeprefix("file:"))
    parts = {step.name: sorted(p.name for p in step.iterdir() if p.is_dir()) for step in sorted(folder.iterdir()) if step.is_dir()}
    assert parts["p=000000001"] == ["_part=2024-01"]
    assert parts["p=000000002"] == ["_part=2024-01", "_part=2024-02"]
    assert (Path(loaded.folder("stg_ataru_hakemus")) / "a=000000002").exists()


def test_cleanup_only_after_release(spark, tmp_path):
    from lakemart.plans import housekeeping

    tables = Tables(spark, str(tmp_path))
    deliveries = [(d.FIRST, d.FIRST_AT), (d.SECOND, d.SECOND_AT)]
    for n, at in ((1, datetime(2024, 1, 10, 13)), (2, datetime(2024, 2, 10, 11))):
        done = run(tables, sources(spark, *deliveries[:n]), at, ["dw_sure_suoritus"])
        completed = housekeeping.note_run(tables, done, at)
    assert rows(completed, "raw_table", "start_time", "execute") == [("sure_suoritus", datetime(2024, 2, 10, 11), False)]
    assert housekeeping.clean(tables) == [] and tables.read("stg_sure_suoritus").count() == 3
    housekeeping.release(tables, "sure_suoritus")
    assert housekeeping.clean(tables) == ["sure_suoritus"]
    assert rows(tables.read("stg_sure_suoritus"), "resourceid", "poistettu") == [("S1", True)]


def test_results_without_queue_are_orphans(rebuilt, spark):
    from lakemart.plans.housekeeping import without_orphans

    results = spark.createDataFrame(
        [(d.T1, "J1"), (d.T1, "J9"), (d.T2, "J1")], "hakukohde_oid string, valintatapajono_oid string"
    )
    kept = without_orphans(results, rebuilt["int_valintaperusteet_hakukohde"])
    assert rows(kept, "hakukohde_oid", "valintatapajono_oid") == [(d.T1, "J1")]
