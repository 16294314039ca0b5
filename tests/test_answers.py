import json

from pyspark.sql import functions as F

from lakemart.plans import applications

TARGET = "1.2.246.562.20."
GENERAL, ASKED = "lukio_opinnot_ammatillisen_perustutkinnon_ohella", applications.DOUBLE_IDS[0]


def test_documents_are_parsed_once_for_matched_and_unmatched_answers(rows):
    documents = [
        ("A1", "L", ["t1", f"{TARGET}5"], {GENERAL: "0"}),
        ("A2", "L", [f"{TARGET}7"], {ASKED: "x", f"{ASKED}_{TARGET}7": "1"}),
        ("A3", "L", [f"{TARGET}5"], {"other": "0"}),
        (None, "L", [f"{TARGET}5"], {GENERAL: "1"}),
    ]
    found = rows([(o, f, json.dumps(c), json.dumps(k)) for o, f, c, k in documents], "hakemus_oid string, lomake_id string, hakukohde string, tiedot string")
    found = found.withColumn("dw_metadata_dw_stored_at", F.lit("2024-01-01").cast("timestamp"))
    targets = rows([("L", GENERAL, f"{TARGET}5")], "lomake_id string, kysymys_id string, hakukohde_oid string")
    answers = applications.int_kaksoistutkinto_hakukohde(found, targets)
    got = sorted(((r.hakemus_oid, r.hakukohde_oid, r.kaksoistutkinto_kiinnostaa) for r in answers.collect()), key=str)
    # a key that is null equals none, so its answer also counts as unmatched
    assert got == sorted([
        ("A1", f"{TARGET}5", True), ("A2", None, None), ("A2", f"{TARGET}7", False), (None, f"{TARGET}5", False), (None, GENERAL, False),
    ], key=str)
    assert "tiedot" not in answers._jdf.queryExecution().optimizedPlan().toString()


def test_health_answers_are_parsed_once_for_an_application(rows):
    documents = [
        ("A1", [f"{TARGET}5", f"{TARGET}6"], {f"sora-terveys_{TARGET}5": "1", f"sora-aiempi_{TARGET}5": "0", "sora-terveys": "0", "x": "1"}),
        ("A2", [f"{TARGET}5"], {f"{applications.HEALTH[0]}_{TARGET}5": None, f"{applications.EARLIER[0]}_{TARGET}5": "1", "sora-terveys": "0"}),
        ("A3", [f"{TARGET}5"], {f"sora-terveys_{TARGET}5": "1"}),
    ]
    found = rows([(o, json.dumps(c), json.dumps(k)) for o, c, k in documents], "hakemus_oid string, hakukohde string, tiedot string")
    answers = applications.int_ataru_soratietoja(found.withColumn("dw_metadata_dw_stored_at", F.lit("2024-01-01").cast("timestamp")))
    got = {(r.hakemus_oid, r.hakukohde_oid, r.sora_terveys, r.sora_aiempi) for r in answers.collect()}
    assert got == {("A1", f"{TARGET}5", True, False), ("A2", f"{TARGET}5", False, True)}
    plan = answers._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = max(i for i, line in enumerate(plan) if "Generate" in line)
    assert any("map_entries" in line for line in plan[last + 1 :]) and not any("map_entries" in line for line in plan[:last])
