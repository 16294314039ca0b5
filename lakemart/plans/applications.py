"""Integration layer: applications, choices, selection and persons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx, seasons, text
from lakemart.functions.keys import surrogate_key
from lakemart.operators import aggregates, joins, latest
from lakemart.plans.dw import current
from lakemart.plans.int1 import HIGHER_BASE_EDUCATION, choice_key, target_person_key
from lakemart.plans.model import Since, model
from lakemart.plans.shapes import SHAPES, SPECIAL_QUESTIONS
from lakemart.session import stored

STORED = "dw_metadata_dw_stored_at"

# --- grades ---


@model()
def int_arvosana_yo(int_sure_arvosana: DataFrame, int_sure_suoritus: DataFrame) -> DataFrame:
    """Matriculation grades per person as a JSON object subject -> grade."""
    grades = int_sure_arvosana.filter(F.col("asteikko") == "YO").withColumn(
        "_order", F.struct("muokattu", "resourceid")
    )
    objects = aggregates.object_per_key(grades, ["suoritus"], "yo_aine", "arvosana", "_order", "arvosanat")
    achievements = int_sure_suoritus.filter("NOT poistettu").select(F.col("resourceid").alias("suoritus"), "henkilo_oid")
    return achievements.join(objects, ["suoritus"]).select("henkilo_oid", "arvosanat").distinct()


@model()
def int_arvosana_yo_supa(int_supa_opiskeluoikeus: DataFrame, int_onr_henkilo: DataFrame) -> DataFrame:
    """The same from the second source: subjects of completed examinations."""
    rights = jsonx.records(
        jsonx.at("data", "yoOpiskeluoikeudet"),
        "yoTutkinto struct<supaTila: string, "
        "aineet: array<struct<koodi: struct<arvo: string>, arvosana: struct<arvo: string>>>>",
    )
    exams = F.filter(rights, lambda r: r["yoTutkinto"]["supaTila"] == "VALMIS")
    subjects = F.flatten(F.transform(exams, lambda r: r["yoTutkinto"]["aineet"]))
    rows = int_supa_opiskeluoikeus.select("henkilo_oid", F.posexplode(subjects).alias("_order", "a")).select(
        "henkilo_oid", "_order", F.col("a.koodi.arvo").alias("aine"), F.col("a.arvosana.arvo").alias("arvosana")
    )
    objects = aggregates.object_per_key(rows, ["henkilo_oid"], "aine", "arvosana", "_order", "arvosanat")
    return objects.join(int_onr_henkilo.select("henkilo_oid", "master_oid"), ["henkilo_oid"]).select(
        "master_oid", "henkilo_oid", "arvosanat"
    )


# --- answers of applications ---


@model(load="replace", keys=("hakemus_oid",), since=Since(STORED, inclusive=True))
def int_hakemus_tiedot(int_ataru_hakemus: DataFrame) -> DataFrame:
    return int_ataru_hakemus.select(
        "hakemus_oid", F.explode(jsonx.entries("tiedot")).alias("kysymys", "vastaus"), STORED
    )


# questions about health and earlier loss of study rights: question id, short name (fixed values)
HEALTH = ("6a5e1a0f-f47e-479e-884a-765b85bd438c", "sora-terveys")
EARLIER = ("66a6855f-d807-4331-98ea-f14098281fc1", "sora-aiempi")


@model(load="merge", keys=("hakutoive_id",), since=Since(STORED))
def int_ataru_soratietoja(int_ataru_hakemus: DataFrame) -> DataFrame:
    """Choices for which both questions were answered.

    Choices and answers are in the same document, so they are matched within
    the row; nothing is joined or shuffled.
    """
    def named(entry: Column, question: tuple[str, str]) -> Column:
        long, short = question
        return entry["key"].like(f"{long}_%") | entry["key"].startswith(short)

    asked = int_ataru_hakemus.filter(jsonx.has_any_key("tiedot", [*HEALTH, *EARLIER]))
    # parsed once for an application, not once for each of its choices
    answered = F.filter(F.map_entries(jsonx.entries("tiedot")), lambda e: named(e, HEALTH) | named(e, EARLIER))
    rows = asked.select("hakemus_oid", "hakukohde", answered.alias("answers"), STORED).select(
        "hakemus_oid", F.explode(jsonx.elements("hakukohde")).alias("hakukohde_oid"), "answers", STORED
    )

    def answers(question: tuple[str, str]) -> Column:
        def fits(entry: Column) -> Column:
            return named(entry, question) & (F.split_part(entry["key"], F.lit("_"), F.lit(2)) == F.col("hakukohde_oid"))

        return F.transform(F.filter("answers", fits), lambda e: F.coalesce(e["value"] == "1", F.lit(False)))

    matched = rows.withColumn("sora_terveys", F.explode(answers(HEALTH))).withColumn(
        "sora_aiempi", F.explode(answers(EARLIER))
    )
    return matched.select(choice_key(), "hakemus_oid", "hakukohde_oid", "sora_terveys", "sora_aiempi", STORED)


@model()
def int_lomake_hakukohde(dw_ataru_lomake: DataFrame, int_hakukohderyhma_hakukohde: DataFrame) -> DataFrame:
    """Which targets a special question of a form belongs to, through the
    groups that the question names; newest version of each form."""
    forms = dw_ataru_lomake.filter("kaksois_urheilija_tutkinto").withColumnRenamed("id", "lomake_id")
    newest = latest.newest_with_ties(forms, ["lomake_id"], "versio_id")
    questions = newest.select(
        "lomake_id", F.inline(jsonx.records("content", "id string, `belongs-to-hakukohderyhma` array<string>"))
    ).filter(F.col("id").isin(*SPECIAL_QUESTIONS))
    groups = questions.select(
        "lomake_id", F.col("id").alias("kysymys_id"), F.explode("belongs-to-hakukohderyhma").alias("hakukohderyhma_oid")
    )
    members = int_hakukohderyhma_hakukohde.select("hakukohderyhma_oid", "hakukohde_oid")
    return groups.join(members, ["hakukohderyhma_oid"], "left").select("lomake_id", "kysymys_id", "hakukohde_oid")


TARGET_ID = r"1\.2\.246\.562.*"
BEFORE_TARGET_ID = r".*(?=_1\.2\.246)"


def question_answers(
    applications: DataFrame, form_targets: DataFrame, asked: list[str], prefixes: list[str], general: list[str],
    questions: list[str], keep_unmatched: bool,
) -> DataFrame:
    """Answers to questions that concern some of the choices.

    A key is either a general question or ``question_target``.  The targets a
    question concerns come from the form; they count if the applicant chose
    them.  The choices are exploded first, so the join is on form and target
    and not on the form alone, which many applications share.
    """
    matches_prefix = F.lit(False)
    for prefix in prefixes:
        matches_prefix = matches_prefix | F.col("key").like(prefix + "%")
    rows = applications.filter(jsonx.has_any_key("tiedot", asked)).select(
        "hakemus_oid", "lomake_id", "hakukohde", STORED, F.explode(jsonx.entries("tiedot")).alias("key", "arvo")
    ).filter(matches_prefix & F.col("arvo").isNotNull())
    is_general = F.col("key").isin(*general)
    rows = rows.withColumns(
        {
            "subject": F.when(is_general, F.col("key")).otherwise(text.find("key", TARGET_ID)),
            "question": F.when(~is_general, text.find("key", BEFORE_TARGET_ID)),
        }
    )
    if keep_unmatched:
        # read for the matched answers and for the rest: parsing the documents is the work here
        rows = stored(rows, "answers")
    choices = rows.withColumn("hakukohde_oid", F.explode(F.array_distinct(jsonx.elements("hakukohde"))))
    targets = form_targets.filter(F.col("kysymys_id").isin(*questions) & F.col("hakukohde_oid").isNotNull())
    matched = choices.join(targets, ["lomake_id", "hakukohde_oid"]).filter(
        (F.col("subject") == F.col("kysymys_id")) | (F.col("subject") == F.col("hakukohde_oid"))
    )
    shown = ["hakemus_oid", "hakukohde_oid", F.coalesce("question", "subject").alias("kysymys_id"), "arvo", STORED]
    if not keep_unmatched:
        return matched.select(*shown)
    matched = stored(matched.drop("hakukohde"), "matched-answers")
    rest = rows.join(matched.select("hakemus_oid", "key"), ["hakemus_oid", "key"], "left_anti")
    return matched.select(*shown).unionByName(rest.withColumn("hakukohde_oid", F.col("subject")).select(*shown))


def interested(questions: list[str]) -> Column:
    """Answer '0' means yes and '1' no."""
    known = F.col("kysymys_id").isin(*questions)
    return F.when(known & (F.col("arvo") == "0"), F.lit(True)).when(known & (F.col("arvo") == "1"), F.lit(False))


# double degree: question ids and names (fixed values)
DOUBLE_IDS = ["4fe08958-c0b7-4847-8826-e42503caa662", "32b8440f-d6f0-4a8b-8f67-873344cc3488"]
DOUBLE_GENERAL = ["lukio_opinnot_ammatillisen_perustutkinnon_ohella", "ammatilliset_opinnot_lukio_opintojen_ohella-amm"]
DOUBLE_PREFIXES = [
    *DOUBLE_IDS, "lukio_opinnot_ammatillisen_perustutkinnon_ohella", "ammatilliset_opinnot_lukio_opintojen_ohella",
]
ATHLETE_ID, ATHLETE_GENERAL = "1dc3311d-2235-40d6-88d2-de2bd63e087b", "ammatillinen_perustutkinto_urheilijana"


@model(load="merge", keys=("hakutoive_id",), parent=("hakemus_oid",), since=Since(STORED))
def int_kaksoistutkinto_hakukohde(int_ataru_hakemus: DataFrame, int_lomake_hakukohde: DataFrame) -> DataFrame:
    answers = question_answers(
        int_ataru_hakemus, int_lomake_hakukohde, [*DOUBLE_IDS, *DOUBLE_GENERAL], DOUBLE_PREFIXES, DOUBLE_GENERAL,
        [*DOUBLE_IDS, *DOUBLE_GENERAL], keep_unmatched=True,
    )
    return answers.select(
        choice_key(), "hakemus_oid", "hakukohde_oid", interested(DOUBLE_PREFIXES).alias("kaksoistutkinto_kiinnostaa"),
        STORED, F.lit(False).alias("poistettu"),
    )


@model()
def int_urheilijatutkinto_hakukohde(int_ataru_hakemus: DataFrame, int_lomake_hakukohde: DataFrame) -> DataFrame:
    both = [ATHLETE_ID, ATHLETE_GENERAL]
    answers = question_answers(
        int_ataru_hakemus, int_lomake_hakukohde, both, both, [ATHLETE_GENERAL], both, keep_unmatched=False
    )
    return answers.select(
        choice_key(), "hakemus_oid", "hakukohde_oid", interested(both).alias("urheilijatutkinto_kiinnostaa")
    )


@model()
def int_maksuvelvollisuus(int_ataru_hakemus: DataFrame) -> DataFrame:
    reviews = jsonx.records("kasittelymerkinnat", "requirement string, hakukohde string, state string")
    payment = F.filter(reviews, lambda r: r["requirement"] == "payment-obligation")
    rows = int_ataru_hakemus.select("hakemus_oid", F.explode(payment).alias("r"))
    return rows.select(
        surrogate_key("hakemus_oid", "r.hakukohde").alias("hakutoive_id"), F.col("r.state").alias("maksuvelvollisuus")
    )


# --- first-timers, discretion, base education ---


@model()
def int_ensikertalainen(int_sure_ensikertalainen: DataFrame) -> DataFrame:
    return int_sure_ensikertalainen.select(
        "henkilo_oid", "haku_oid", "isensikertalainen", "menettamisenperuste", "menettamisenpaivamaara"
    )


@model()
def int_harkinnanvaraisuus(int_sure_harkinnanvaraisuus: DataFrame) -> DataFrame:
    return int_sure_harkinnanvaraisuus.select("hakutoive_id", "hakemus_oid", "hakukohde_oid", "harkinnanvaraisuuden_syy")


@model()
def int_pohjakoulutus(int_sure_proxysuoritus: DataFrame, int_koodisto_pohjakoulutustoinenaste: DataFrame) -> DataFrame:
    known = int_koodisto_pohjakoulutustoinenaste.filter("viimeisin_versio").select(
        F.col("koodiarvo").alias("pohjakoulutus"), F.col("koodinimi").alias("pohjakoulutus_nimi")
    )
    rows = int_sure_proxysuoritus.select(
        F.col("hakemusoid").alias("hakemus_oid"), jsonx.at("keyvalues", "POHJAKOULUTUS").cast("int").alias("pohjakoulutus")
    )
    return rows.join(known, ["pohjakoulutus"]).select("hakemus_oid", "pohjakoulutus", "pohjakoulutus_nimi")


@model(load="replace_changed", keys=("hakemus_oid",), since=Since(STORED, inclusive=True))
def int_supa_tieto(int_supa_valintadata: DataFrame) -> DataFrame:
    return int_supa_valintadata.select("hakemus_oid", F.explode(jsonx.entries("keyvalues")).alias("avain", "arvo"), STORED)


# --- offers ---


def code_list(uris: str, code) -> Column:
    """Sorted codes of a JSON array of code uris, NULL for an empty one."""
    values = F.array_sort(F.transform(jsonx.elements(uris), code))
    return F.when(F.size(values) > 0, F.to_json(values))


@model()
def int_haku(int_kouta_haku: DataFrame, int_ohjausparametrit_parameter: DataFrame) -> DataFrame:
    """Searches with their parameters, start season, and the season and year
    of the earliest application period."""
    periods = F.transform(
        jsonx.records("hakuajat", "alkaa string, paattyy string"),
        lambda p: F.struct(
            p["alkaa"].isNull().alias("undated"), p["alkaa"].cast("timestamp").alias("alkaa"),
            p["paattyy"].cast("timestamp").alias("paattyy"),
        ),
    )
    parameters = int_ohjausparametrit_parameter.select(
        "haku_oid", "vastaanotto_paattyy", "hakijakohtainen_paikan_vastaanottoaika", "jarjestetyt_hakutoiveet"
    )
    rows = int_kouta_haku.join(parameters, ["haku_oid"], "left").withColumn(
        "_first", F.get(F.array_sort(periods), F.lit(0))
    )
    day = F.coalesce("_first.paattyy", "_first.alkaa")
    season = F.when(F.month(day) < seasons.FIRST_AUTUMN_MONTH, seasons.SPRING).when(day.isNotNull(), seasons.AUTUMN)
    return rows.select(
        "haku_oid", "haku_nimi", F.col("externalid").alias("ulkoinen_tunniste"), "tila",
        F.col("organisaatiooid").alias("organisaatio_oid"), "hakutapakoodiuri", "hakukohteenliittamisentakaraja",
        "hakukohteenmuokkaamisentakaraja", "hakukohteenliittajaorganisaatiot", "kohdejoukkokoodiuri",
        "kohdejoukontarkennekoodiuri", "koulutuksen_alkamiskausi",
        seasons.start_json("koulutuksen_alkamiskausi").alias("koulutuksen_alkamiskausikoodi"), "hakuajat", "haun_tyyppi",
        "vastaanotto_paattyy", "hakijakohtainen_paikan_vastaanottoaika", "jarjestetyt_hakutoiveet",
        (F.col("hakutapakoodiuri") == "hakutapa_05#1").alias("siirtohaku"),
        F.coalesce(season, F.lit("")).alias("haku_kausi"), F.year(day).cast("string").alias("haku_vuosi"),
    )


@model()
def int_hakukohde(
    int_kouta_hakukohde: DataFrame, int_kouta_toteutus: DataFrame, int_kouta_valintaperuste: DataFrame,
    int_valintaperusteet_aloituspaikat: DataFrame,
) -> DataFrame:
    languages = int_kouta_toteutus.select(
        "toteutus_oid", code_list("opetuskielikoodiurit", text.code_uri).alias("oppilaitoksen_opetuskieli")
    )
    places = int_valintaperusteet_aloituspaikat.withColumnRenamed("aloituspaikat", "valintaperusteiden_aloituspaikat")
    criteria = int_kouta_valintaperuste.select("valintaperuste_id", "valintaperuste_nimi")
    return (
        int_kouta_hakukohde.join(places, ["hakukohde_oid"], "left")
        .join(languages, ["toteutus_oid"], "left")
        .join(criteria, ["valintaperuste_id"], "left")
        .select(
            "hakukohde_oid", "haku_oid", "toteutus_oid", "ulkoinen_tunniste", "hakukohde_nimi", "jarjestyspaikka_oid", "tila",
            (jsonx.length("valintakokeet") > 0).alias("on_valintakoe"), "aloituspaikat_ensikertalaisille",
            "hakukohdekoodiuri", "kaytetaanhaunaikataulua", "hakuajat",
            F.col("koulutuksenalkamiskausi").alias("koulutuksen_alkamiskausi"),
            seasons.start_json("koulutuksenalkamiskausi").alias("koulutuksen_alkamiskausikoodi"),
            "toinenasteonkokaksoistutkinto", "jarjestaaurheilijanammkoulutusta",
            F.col("aloituspaikat").cast("bigint").alias("hakukohteen_aloituspaikat"),
            code_list("pohjakoulutusvaatimuskoodiurit", text.code_value).alias("pohjakoulutuskoodit"),
            "valintaperusteiden_aloituspaikat", "oppilaitoksen_opetuskieli", "valintaperuste_nimi",
        )
    )


@model()
def int_toteutus_koulutuksen_alkamiskausi(int_kouta_toteutus: DataFrame, int_hakukohde: DataFrame) -> DataFrame:
    """Start season of each implementation per search that offers it."""
    searches = int_hakukohde.select("toteutus_oid", "haku_oid").distinct()
    starts = int_kouta_toteutus.filter("koulutuksen_alkamiskausi IS NOT NULL").select(
        "toteutus_oid", seasons.start_json("koulutuksen_alkamiskausi").alias("koulutuksen_alkamiskausikoodi")
    )
    return starts.join(searches, ["toteutus_oid"], "left").select(
        surrogate_key("toteutus_oid", "haku_oid").alias("toteutus_id"), "toteutus_oid", "haku_oid",
        "koulutuksen_alkamiskausikoodi",
    )


@model()
def int_koulutus_koulutuskoodi(dw_kouta_koulutus: DataFrame) -> DataFrame:
    uris = current(dw_kouta_koulutus, "oid").select("oid", F.explode(jsonx.elements("koulutuksetkoodiuri")).alias("koulutuskoodiuri"))
    return uris.withColumn("koulutuskoodiarvo", text.code_value("koulutuskoodiuri"))


@model()
def int_hakukohderyhma_hakukohde(int_hakukohderyhmapalvelu_ryhma: DataFrame, int_organisaatio_ryhma: DataFrame) -> DataFrame:
    members = int_hakukohderyhmapalvelu_ryhma.select(
        F.col("oid").alias("hakukohderyhma_oid"), F.explode(jsonx.elements("hakukohde_oid")).alias("hakukohde_oid"), "muokattu"
    )
    return members.join(int_organisaatio_ryhma, ["hakukohderyhma_oid"], "left").select(
        surrogate_key("hakukohderyhma_oid", "hakukohde_oid").alias("hakukohderyhma_id"), "hakukohderyhma_oid",
        "hakukohderyhma_nimi", "hakukohde_oid", "muokattu",
    )


# --- selection criteria ---


@model()
def int_hakukohde_valintaperuste(int_valintaperusteet_avain: DataFrame) -> DataFrame:
    criteria = jsonx.records(
        jsonx.at("data", "valintaperusteDTO"),
        "tunniste string, kuvaus string, min string, max string, lahde string, funktiotyyppi string, "
        "onPakollinen string, tilastoidaan string",
    )
    rows = int_valintaperusteet_avain.select("hakukohde_oid", F.explode(criteria).alias("c"))
    return rows.select(
        surrogate_key("hakukohde_oid", "c.tunniste").alias("hakukohde_valintaperuste_id"), "hakukohde_oid",
        "c.tunniste", "c.kuvaus", "c.min", "c.max", "c.lahde", "c.funktiotyyppi",
        F.col("c.onPakollinen").cast("boolean").alias("on_pakollinen"), F.col("c.tilastoidaan").cast("boolean").alias("tilastoidaan"),
    )


QUEUE_FIELDS = """
    oid nimi tyyppi lastModified prioriteetti aloituspaikat tasasijasaanto valisijoittelu merkitseMyohAuto
    eiVarasijatayttoa poissaOlevaTaytto jarjestyskriteerit poistetaankoHylatyt valmisSijoiteltavaksi
    siirretaanSijoitteluun kaytetaanValintalaskentaa kaikkiEhdonTayttavatHyvaksytaan
""".split()
EXAM_FIELDS = """
    oid nimi kuvaus peritty tunniste aktiivinen kutsunKohde lastModified kutsutaankoKaikki lahetetaankoKoekutsut
""".split()


def texts(names: list[str]) -> str:
    return ", ".join(f"{n} string" for n in names)


def phases(shape: str) -> Column:
    return jsonx.records("valinnanvaiheet", shape)


@model()
def int_valintaperusteet_aloituspaikat(int_valintaperusteet_hakukohde: DataFrame) -> DataFrame:
    """Study places of the queues that go to allocation, added up within the
    document of each target."""
    queues = F.flatten(
        F.transform(
            phases("valintatapajono array<struct<aloituspaikat: string, siirretaanSijoitteluun: string>>"),
            lambda p: F.coalesce(
                p["valintatapajono"],
                F.array().cast("array<struct<aloituspaikat: string, siirretaanSijoitteluun: string>>"),
            ),
        )
    )
    counts = F.transform(
        "queues",
        lambda q: F.when(F.coalesce(q["siirretaanSijoitteluun"].cast("boolean"), F.lit(False)), q["aloituspaikat"].cast("bigint"))
        .otherwise(F.lit(0)),
    )
    known = F.filter(counts, lambda n: n.isNotNull())
    total = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("bigint"), lambda a, n: a + n))
    rows = int_valintaperusteet_hakukohde.withColumn("queues", queues).filter(F.size("queues") > 0)
    return rows.select("hakukohde_oid", total.alias("aloituspaikat"))


@model()
def int_valintaperusteet_valintakoe(int_valintaperusteet_hakukohde: DataFrame) -> DataFrame:
    exams = phases(f"valintakoe array<struct<{', '.join(f'{n}: string' for n in EXAM_FIELDS)}>>")
    rows = int_valintaperusteet_hakukohde.select("hakukohde_oid", F.explode(exams).alias("p")).select(
        "hakukohde_oid", F.explode("p.valintakoe").alias("k")
    )

    def flag(name: str) -> Column:
        return F.col(f"k.{name}").cast("boolean")

    return rows.select(
        F.col("k.oid").alias("valintakoe_id"), "hakukohde_oid", F.col("k.nimi").alias("valintakoe_nimi"),
        F.col("k.kuvaus").alias("valintakoe_kuvaus"), flag("peritty").alias("valintakoe_peritty"),
        F.col("k.tunniste").alias("valintakoe_tunniste"), flag("aktiivinen").alias("valintakoe_aktiivinen"),
        F.col("k.kutsunKohde").alias("valintakoe_kutsun_kohde"), F.col("k.lastModified").cast("timestamp").alias("muokattu"),
        flag("kutsutaankoKaikki").alias("valintakoe_kutsutaanko_kaikki"),
        flag("lahetetaankoKoekutsut").alias("valintakoe_lahetetaanko_koekutsut"),
    )


@model()
def int_valintaperusteet_valintatapajono(int_valintaperusteet_hakukohde: DataFrame) -> DataFrame:
    queues = phases(f"valinnanVaiheOid string, valintatapajono array<struct<{', '.join(f'{n}: string' for n in QUEUE_FIELDS)}>>")
    rows = int_valintaperusteet_hakukohde.select("hakukohde_oid", F.explode(queues).alias("p")).select(
        "hakukohde_oid", F.col("p.valinnanVaiheOid").alias("valinnanvaihe_id"), F.explode("p.valintatapajono").alias("q")
    )

    def flag(name: str) -> Column:
        return F.col(f"q.{name}").cast("boolean")

    return rows.select(
        F.col("q.oid").alias("valintatapajono_id"), F.col("q.nimi").alias("valintatapajono_nimi"),
        F.col("q.tyyppi").alias("valintatapajono_tyyppi"), "valinnanvaihe_id", "hakukohde_oid",
        F.col("q.lastModified").cast("timestamp_ntz").alias("muokattu"), F.col("q.prioriteetti").cast("int").alias("prioriteetti"),
        F.col("q.aloituspaikat").cast("int").alias("aloituspaikat"), "q.tasasijasaanto", flag("valisijoittelu").alias("valisijoittelu"),
        flag("merkitseMyohAuto").alias("merkitse_myoh_auto"), flag("eiVarasijatayttoa").alias("ei_varasijatayttoa"),
        flag("poissaOlevaTaytto").alias("poissaoleva_taytto"), "q.jarjestyskriteerit",
        flag("poistetaankoHylatyt").alias("poistetaanko_hylatyt"), flag("valmisSijoiteltavaksi").alias("valmis_sijoiteltavaksi"),
        flag("siirretaanSijoitteluun").alias("siirretaan_sijoitteluun"),
        flag("kaytetaanValintalaskentaa").alias("kaytetaan_valintalaskentaa"),
        flag("kaikkiEhdonTayttavatHyvaksytaan").alias("kaikki_ehdon_tayttyvat_hyvaksytaan"),
    )


@model()
def int_hakutoive_osallistuminen(int_valintalaskenta_valintakoe_osallistuminen: DataFrame) -> DataFrame:
    """Exams of each choice, out of three nested arrays parsed at once."""
    choices = jsonx.records(
        "hakutoiveet",
        "hakukohdeOid string, valinnanVaiheet array<struct<valintakokeet: array<struct<nimi: string, aktiivinen: string, "
        "lastModified: string, valintakoeOid: string, valintakoeTunniste: string, osallistuminenTulos: "
        "struct<laskentaTila: string, laskentaTulos: string, osallistuminen: string>, lahetetaankoKoekutsut: string>>>>",
    )
    rows = (
        int_valintalaskenta_valintakoe_osallistuminen.select(
            F.col("hakemusoid").alias("hakemus_oid"), F.explode(choices).alias("c")
        )
        .select("hakemus_oid", F.col("c.hakukohdeOid").alias("hakukohde_oid"), F.explode("c.valinnanVaiheet").alias("p"))
        .select("hakemus_oid", "hakukohde_oid", F.explode("p.valintakokeet").alias("k"))
    )
    return rows.select(
        choice_key(), "hakemus_oid", "hakukohde_oid", "k.nimi", F.col("k.aktiivinen").cast("boolean").alias("aktiivinen"),
        F.col("k.lastModified").cast("timestamp").alias("last_modified"), F.col("k.valintakoeOid").alias("valintakoe_oid"),
        F.col("k.valintakoeTunniste").alias("valintakoe_tunniste"),
        F.col("k.osallistuminenTulos.laskentaTila").alias("laskenta_tila"),
        F.col("k.osallistuminenTulos.laskentaTulos").alias("laskenta_tulos"),
        F.col("k.osallistuminenTulos.osallistuminen").alias("osallistuminen"),
        F.col("k.lahetetaankoKoekutsut").cast("boolean").alias("lahetetaanko_koekutsut"),
    )


# --- selection results ---


@model(load="merge", keys=("valintatapajono_oid",), newer="muokattu", since=Since("dw_metadata_stg_stored_at"))
def int_sijoitteluajo(stg_valintarekisteri_jonosija: DataFrame) -> DataFrame:
    """Latest allocation run of each queue."""
    return latest.newest_per_key(stg_valintarekisteri_jonosija, ["valintatapajono_oid"], "muokattu", "sijoitteluajo_id").select(
        "valintatapajono_oid", "sijoitteluajo_id", "muokattu", "dw_metadata_stg_stored_at"
    )


ACCEPTED_IN_QUEUE = ("HYVAKSYTTY", "HYVAKSYTTY_VARASIJALTA")
BY_DISCRETION = "HARKINNANVARAISESTI_HYVAKSYTTY"


# states from best to worst (fixed values)
STATE_ORDER = """
    HYVAKSYTTY HARKINNANVARAISESTI_HYVAKSYTTY VARASIJALTA_HYVAKSYTTY VARALLA PERUUTETTU PERUNUT PERUUNTUNUT HYLATTY KESKEN
""".split()


@model()
def int_hakutoive_valintatapajono(
    int_valintarekisteri_valinnantulos: DataFrame, int_valintarekisteri_jonosija: DataFrame,
    int_valintarekisteri_valintatapajono: DataFrame,
) -> DataFrame:
    """Results of a choice in all its queues as a JSON array, in queue order."""
    # digests do not compress, so the shuffles carry the columns that they are made of
    digests = ("hakutoive_id", "hakemus_hakukohde_valintatapa_id")
    parts = ("hakemus_oid", "hakukohde_oid", "valintatapajono_oid")
    placed = {p: f"_place_{p}" for p in parts}
    places = int_valintarekisteri_jonosija.drop(*digests, "jonosija_id", "sijoitteluajo_id").withColumnsRenamed(placed | {"prioriteetti": "_place_priority"})
    queues = int_valintarekisteri_valintatapajono.select("valintatapajono_oid", "valintatapajono_nimi", "prioriteetti")
    # in the order of their own digest, by which the results are shuffled already
    _, parts = SHAPES["valintarekisteri_valinnantulos"].key
    rows = int_valintarekisteri_valinnantulos.drop(*digests, "valinnantulos_id").join(
        places, surrogate_key(*parts) == surrogate_key(*[placed[p] for p in parts]), "left"
    ).drop(*placed.values()).join(queues, ["valintatapajono_oid"], "left")
    accepted = F.col("valinnan_tila").isin(*ACCEPTED_IN_QUEUE)
    state = F.when(accepted & F.col("hyvaksytty_harkinnanvaraisesti"), BY_DISCRETION).otherwise(F.col("valinnan_tila"))
    result = F.struct(
        "valintatapajono_oid",
        F.coalesce("valintatapajono_nimi", F.lit("Valintatapajono")).alias("valintatapajono_nimi"),
        state.alias("valinnan_tila"),
        "valintatiedon_pvm",
        (accepted & F.col("ehdollisesti_hyvaksyttavissa")).alias("ehdollisesti_hyvaksytty"),
        jsonx.translated("ehdollisen_hyvaksymisen_ehto").alias("ehdollisen_hyvaksymisen_ehto"),
        jsonx.translated("valinnantilan_kuvauksen_teksti").alias("valinnantilan_kuvauksen_teksti"),
        "julkaistavissa", "hyvaksyperuuntunut", "hyvaksytty_harkinnanvaraisesti", "jonosija", "varasijan_numero",
        "onko_muuttunut_viime_sijoittelussa", F.coalesce("prioriteetti", F.lit(0)).alias("prioriteetti"), "pisteet",
        "siirtynyt_toisesta_valintatapajonosta",
    )
    # the best state and its earliest day come out of the same aggregate as the list
    rank = F.array_position(F.array(*[F.lit(x) for x in STATE_ORDER]), state)
    day = F.col("valintatiedon_pvm").cast("date")
    best = F.min(F.when(rank > 0, F.struct(rank.alias("rank"), day.isNull().alias("undated"), day.alias("day"), state.alias("state"))))
    flag = F.max(F.coalesce(accepted & F.col("ehdollisesti_hyvaksyttavissa"), F.lit(False)))
    grouped = rows.repartition(surrogate_key("hakemus_oid", "hakukohde_oid")).groupBy(choice_key()).agg(
        jsonx.to_array(F.array_sort(F.collect_list(result))).alias("valintatapajonot"), best.alias("best"), flag.alias("ehdollisesti_hyvaksytty")
    )
    return grouped.select(
        "hakutoive_id", "valintatapajonot", F.col("best.state").alias("valintatieto"), F.col("best.day").alias("valintatiedon_pvm"),
        "ehdollisesti_hyvaksytty",
    )


@model()
def int_valinta(int_hakutoive_valintatapajono: DataFrame) -> DataFrame:
    """Best state over the queues of a choice and the earliest day of it."""
    return int_hakutoive_valintatapajono.select(
        "hakutoive_id", "valintatapajonot", "valintatieto", "valintatiedon_pvm", "ehdollisesti_hyvaksytty"
    )


@model()
def int_vastaanotto(int_valintarekisteri_vastaanotto: DataFrame) -> DataFrame:
    return int_valintarekisteri_vastaanotto.select(
        "hakukohde_henkilo_id", "selite", F.col("operaatio").alias("vastaanottotieto")
    )


@model()
def int_valintarekisteri(int_vastaanotto: DataFrame, int_valintarekisteri_ilmoittautuminen: DataFrame) -> DataFrame:
    """Acceptance and enrolment of a place, either of which may lack."""
    enrolled = int_valintarekisteri_ilmoittautuminen.select(
        "hakukohde_henkilo_id", F.col("tila").alias("ilmoittautumisen_tila")
    )
    return joins.full_on(int_vastaanotto.drop("selite"), enrolled, ["hakukohde_henkilo_id"])


# --- choices ---


@model()
def int_hakutoive(
    int_ataru_hakutoive: DataFrame, int_ataru_hakemus: DataFrame, int_haku: DataFrame,
    int_valintarekisteri_hyvaksyttyjulkaistuhakutoive: DataFrame, int_vastaanotto: DataFrame, int_valinta: DataFrame,
    int_harkinnanvaraisuus: DataFrame, int_valintarekisteri_ilmoittautuminen: DataFrame, int_ensikertalainen: DataFrame,
) -> DataFrame:
    """Valid choices with everything known about them.

    What an application's search and person say is joined to the application, before
    its choices.  Digests do not compress, so the shuffles of the choices carry the
    columns that they are made of.
    """
    searches = int_haku.select(
        "haku_oid", "jarjestetyt_hakutoiveet", "vastaanotto_paattyy", "hakijakohtainen_paikan_vastaanottoaika"
    )
    first_timers = int_ensikertalainen.select(
        "haku_oid", F.col("henkilo_oid").alias("_applicant"), F.col("isensikertalainen").alias("ensikertalainen")
    )
    applications = (
        int_ataru_hakemus.select("hakemus_oid", "haku_oid", F.col("henkilo_oid").alias("_applicant"))
        .join(searches, ["haku_oid"], "left")
        .join(first_timers, ["haku_oid", "_applicant"], "left")
        .drop("_applicant")
    )
    register = "_register"
    published = int_valintarekisteri_hyvaksyttyjulkaistuhakutoive.select(F.col("hakukohde_henkilo_id").alias(register), "hyvaksyttyjajulkaistu")
    accepted = int_vastaanotto.select(F.col("hakukohde_henkilo_id").alias(register), "vastaanottotieto")
    enrolled = int_valintarekisteri_ilmoittautuminen.select(
        F.col("hakukohde_henkilo_id").alias(register), F.col("tila").alias("ilmoittautumisen_tila")
    )
    discretion = int_harkinnanvaraisuus.select(F.col("hakutoive_id").alias("_choice"), "harkinnanvaraisuuden_syy")
    rows = int_ataru_hakutoive.filter("NOT poistettu").drop("hakutoive_id", "hakukohde_henkilo_id").join(applications, ["hakemus_oid"], "left")
    for facts in (published, accepted, enrolled):
        rows = rows.join(facts, surrogate_key("hakukohde_oid", "henkilo_oid") == F.col(register), "left").drop(register)
    for facts in (int_valinta.withColumnRenamed("hakutoive_id", "_choice"), discretion):
        rows = rows.join(facts, surrogate_key("hakemus_oid", "hakukohde_oid") == F.col("_choice"), "left").drop("_choice")
    ordered = F.coalesce("jarjestetyt_hakutoiveet", F.lit(True))
    deadline = seasons.acceptance_deadline(
        F.col("hyvaksyttyjajulkaistu"), F.col("hakijakohtainen_paikan_vastaanottoaika"), F.col("vastaanotto_paattyy")
    )
    return rows.select(
        choice_key(), target_person_key(), surrogate_key("henkilo_oid", "hakemus_oid").alias("henkilo_hakemus_id"),
        "hakemus_oid", "haku_oid", "henkilo_oid", "hakukohde_oid",
        F.when(ordered, F.col("hakutoivenumero")).otherwise(F.lit(-1)).alias("hakutoivenumero"),
        deadline.alias("viimeinen_vastaanottopaiva"), "vastaanottotieto", "ilmoittautumisen_tila", "valintatapajonot",
        "valintatieto", "ehdollisesti_hyvaksytty", "valintatiedon_pvm", "harkinnanvaraisuuden_syy", "ensikertalainen",
        "hakukelpoisuus_asetettu_automaattisesti",
    )


@model(load="replace", keys=("hakemus_oid",), since=Since(STORED, inclusive=True))
def int_hakutoive_kk(int_ataru_hakemus: DataFrame, int_hakutoive: DataFrame, int_kouta_haku: DataFrame) -> DataFrame:
    """Eligibility and base education of choices in higher education."""
    higher = int_kouta_haku.filter(F.col("haun_tyyppi") == "korkeakoulu")
    reviews = jsonx.records("kasittelymerkinnat", "requirement string, hakukohde string, state string")
    reviewed = joins.keep_matching(int_ataru_hakemus, higher, ["haku_oid"]).filter(F.col("tila") != "inactivated").select(
        "hakemus_oid", F.filter(reviews, lambda r: r["requirement"] == "eligibility-state").alias("reviews"),
        jsonx.at("tiedot", HIGHER_BASE_EDUCATION).alias("base"), jsonx.has_key("tiedot", HIGHER_BASE_EDUCATION).alias("answered"),
        STORED,
    ).filter((F.size("reviews") > 0) & F.col("answered"))
    choices = int_hakutoive.select("hakemus_oid", "hakukohde_oid")
    own = F.get(F.filter("reviews", lambda r: r["hakukohde"] == F.col("hakukohde_oid")), F.lit(0))
    return choices.join(reviewed, ["hakemus_oid"]).select(
        choice_key(), "hakemus_oid", "hakukohde_oid", own["state"].alias("hakukelpoisuus"),
        F.replace("base", F.lit("pohjakoulutus_"), F.lit("")).alias("pohjakoulutus"), STORED,
    )


# --- persons ---

FINLAND = "246"
UNION_GROUPS = ("EU", "ETA")


@model(load="replace", keys=("henkilo_oid",), since=Since("muokattu", inclusive=True))
def int_onr_kansalaisuus(int_onr_henkilo: DataFrame, int_koodisto_maa_valtioryhma: DataFrame, int_koodisto_maa_2: DataFrame):
    """Citizenships of a person by class: Finnish, EU or EEA, other; the first
    one in that order is preferred."""
    union = int_koodisto_maa_valtioryhma.filter(F.col("valtioryhma_koodiarvo").isin(*UNION_GROUPS)).select(
        F.col("maa_koodiarvo").alias("kansalaisuus"), F.lit(2).alias("_union")
    ).distinct()
    countries = int_koodisto_maa_2.filter("viimeisin_versio").select(
        F.col("koodiarvo").alias("kansalaisuus"),
        jsonx.build(en=F.col("nimi_en"), sv=F.col("nimi_sv"), fi=F.col("nimi_fi")).alias("kansalaisuus_nimi"),
    )
    rows = int_onr_henkilo.select(
        "henkilo_oid", "muokattu", F.posexplode(jsonx.elements("kansalaisuus")).alias("_place", "kansalaisuus")
    ).join(union, ["kansalaisuus"], "left")
    rows = rows.withColumn(
        "kansalaisuusluokka", F.when(F.col("kansalaisuus") == FINLAND, 1).otherwise(F.coalesce("_union", F.lit(3)))
    )
    rank = F.struct("kansalaisuusluokka", "kansalaisuus", "_place")
    best = rows.groupBy("henkilo_oid").agg(F.min(rank).alias("_best"))
    unknown = jsonx.build(en=F.lit(None).cast("string"), sv=F.lit(None).cast("string"), fi=F.lit(None).cast("string"))
    return rows.join(best, ["henkilo_oid"]).join(countries, ["kansalaisuus"], "left").select(
        "henkilo_oid", "kansalaisuus", "muokattu", F.coalesce("kansalaisuus_nimi", unknown).alias("kansalaisuus_nimi"),
        "kansalaisuusluokka", (rank == F.col("_best")).alias("priorisoitu_kansalaisuus"),
    )


@model(load="replace", keys=("henkilo_oid",), since=Since("muokattu", inclusive=True))
def int_onr_kansalaisuus_nimi(int_onr_henkilo: DataFrame, int_koodisto_maa_2: DataFrame) -> DataFrame:
    """Names of all citizenships of a person as a JSON array."""
    countries = int_koodisto_maa_2.filter("viimeisin_versio").select(F.col("koodiarvo").alias("maa"), "koodinimi")
    rows = int_onr_henkilo.select(
        "henkilo_oid", "muokattu", F.posexplode_outer(jsonx.elements("kansalaisuus")).alias("place", "maa")
    ).join(countries, ["maa"], "left")
    listed = F.array_sort(F.collect_list(F.struct("place", "koodinimi")))
    return rows.groupBy("henkilo_oid", "muokattu").agg(
        jsonx.array_of(F.transform(listed, lambda x: x["koodinimi"])).alias("kansalaisuudet_nimi")
    )
