"""Small source documents with the awkward cases."""

import json
from datetime import datetime

from lakemart.sources.landing import ENVELOPE

T1, T2 = "1.2.246.562.20.1", "1.2.246.562.20.2"
FORM = "11111111-0000-0000-0000-000000000000"


def raw(spark, table, documents, copied):
    rows = [
        (json.dumps(d, ensure_ascii=False), copied, copied, f"{table}__{copied:%Y-%m-%d_%H.%M.%S}Z__1.json", i + 1)
        for i, d in enumerate(documents)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def application(oid, version, person, targets, modified, state="active", **answers):
    return {
        "hakemusOid": oid, "id": version, "form_key": FORM, "form": 1, "state": state, "hakuOid": "H1", "person_oid": person,
        "hakukohde": targets, "modified_time": modified, "created_time": modified, "lang": "fi",
        "application_hakukohde_reviews": [{"requirement": "eligibility-state", "state": "eligible", "hakukohde": t} for t in targets],
        "keyValues": {"gender": "", "asiointikieli": "", "nationality": [["246"], ["752"]], **answers},
    }


BASE_ANSWERS = {
    "higher-completed-base-education": ["pohjakoulutus_yo"],
    "pohjakoulutus_yo--yes-year-of-completion": [["2001"]],
    "secondary-completed-base-education–country": "246",
    "sora-terveys": "0", f"sora-terveys_{T1}": "1", f"sora-aiempi_{T1}": "0",
    "sahkoisen-asioinnin-lupa": "Kyllä",
}

FIRST = {
    "ataru_hakemus": [
        application("A1", 1, "P1", [T1, T2], "2024-01-01T10:00:00Z", **BASE_ANSWERS),
        application("A1", 1, "P1", [T1, T2], "2024-01-01T10:00:00Z", **BASE_ANSWERS),
        application("A2", 5, "P2", [T2], "2024-01-05T10:00:00Z"),
        application("A3", 1, None, [T1], "2024-01-01T10:00:00Z"),
    ],
    "onr_henkilo": [
        {"henkilo_oid": "P1", "kansalaisuus": "752,246", "aidinkieli": "fi", "sukupuoli": 1, "updated": "2024-01-01T00:00:00Z"},
        {"henkilo_oid": "P2", "master_oid": "P1", "kansalaisuus": "", "updated": "2024-01-01T00:00:00Z"},
    ],
    "sure_suoritus": [
        {"resourceId": "S1", "henkiloOid": "P1", "inserted": 1704067200123, "deleted": False},
        {"resourceId": "S2", "henkiloOid": "P2", "inserted": 1704067200123, "deleted": True},
    ],
    "sure_arvosana": [
        {"resourceId": f"G{i}", "suoritus": "S1", "asteikko": "YO", "aine": a, "lisatieto": l, "arvosana": g, "inserted": 1704067200000 + i, "deleted": False}
        for i, (a, l, g) in enumerate([("A", "EN", "L"), ("PITKA", "MA", "E"), ("C", "XX", "M"), ("OUTO", "X", "A")])
    ],
    "valintalaskenta_pistetieto": [
        {"hakemusOID": "A1", "pisteet": [{"tunniste": "koe", "arvo": "7", "last_modified": "2024-01-01T00:00:00Z"}]},
        {"hakemusOID": "A2", "pisteet": []},
    ],
    "supa_ensikertalainen": [
        {"hakemusOid": "A1", "henkiloOid": "P1", "isEnsikertalainen": True},
        {"hakemusOid": "A2", "henkiloOid": "P2", "isEnsikertalainen": False},
    ],
    "valintaperusteet_hakukohde": [
        {"hakukohdeOid": T1, "lastModified": "2024-01-01T00:00", "valinnanVaiheet": [
            {"valinnanVaiheOid": "V1", "nimi": "vaihe", "valinnanVaiheJarjestysluku": 1, "aktiivinen": True,
             "valintatapajono": [{"oid": "J1", "aloituspaikat": 5, "siirretaanSijoitteluun": True}, {"oid": "J2", "aloituspaikat": 3, "siirretaanSijoitteluun": False}],
             "valintakoe": [{"oid": "K1", "nimi": "koe", "aktiivinen": True}]},
            {"valinnanVaiheOid": "V2", "valintatapajono": [{"oid": "J3", "aloituspaikat": 4, "siirretaanSijoitteluun": True}], "valintakoe": []}]},
        {"hakukohdeOid": T2, "lastModified": "2024-01-01T00:00", "valinnanVaiheet": []},
    ],
    "valintarekisteri_vastaanotto": [
        {"hakukohdeOid": T1, "henkiloOid": "P1", "action": "VASTAANOTTANUT_SITOVASTI", "timestamp": "2024-03-01T00:00:00Z"},
        {"hakukohdeOid": T1, "henkiloOid": "P1", "action": "PERUNUT", "timestamp": "2024-04-01T00:00:00Z", "deletedAt": "2024-04-02T00:00:00Z"},
    ],
    "valintalaskenta_valintakoe_osallistuminen": [
        {"hakemusOid": "A1", "createdAt": "Nov 5, 2024, 9:15:02 AM", "hakutoiveet": [{"hakukohdeOid": T1, "valinnanVaiheet": [
            {"valintakokeet": [{"nimi": "koe", "aktiivinen": True, "valintakoeOid": "K1", "osallistuminenTulos": {"osallistuminen": "OSALLISTUI"}}]}]}]},
    ],
    "ohjausparametrit_parameter": [
        {"key": "H1", "lastModified": "2024-01-01T00:00", "values": {"PH_OPVP": {"date": 1720796400999}, "jarjestetytHakutoiveet": False, "PH_X": {"dateStart": 1704067200000}}},
    ],
}

# an older version that comes late, a changed choice list, an inactivated application
SECOND = {
    "ataru_hakemus": [
        application("A1", 2, "P1", [T2], "2024-02-01T10:00:00Z", **BASE_ANSWERS),
        application("A2", 4, "P2", [T1], "2024-01-04T10:00:00Z"),
        application("A4", 1, "P1", [T1], "2024-02-01T10:00:00Z", state="inactivated"),
    ],
    "sure_suoritus": [{"resourceId": "S1", "henkiloOid": "P1", "inserted": 1704000000000, "deleted": True}],
    "supa_ensikertalainen": [{"hakemusOid": "A4", "henkiloOid": "P1", "isEnsikertalainen": True}],
    "valintalaskenta_pistetieto": [
        {"hakemusOID": "A1", "pisteet": [{"tunniste": "koe", "arvo": "9", "last_modified": "2024-02-01T00:00:00Z"}]},
    ],
}

FIRST_AT, SECOND_AT = datetime(2024, 1, 10, 12), datetime(2024, 2, 10, 12)
