"""Report layer: dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx, seasons, text
from lakemart.functions.keys import surrogate_key
from lakemart.operators import aggregates, joins
from lakemart.plans.gen import copy_of, pick
from lakemart.plans.model import add, model

# --- plain dimensions ---

copy_of("int_arvosana_yo", "pub_dim_arvosana_yo")
copy_of("int_maksuvelvollisuus", "pub_dim_maksuvelvollisuus")
add("pub_dim_valinnantulos", lambda rows: rows.drop("valinnantulos_id"), ("int_valintarekisteri_valinnantulos",))


@model()
def pub_dim_haku(
    int_haku: DataFrame, pub_dim_koodisto_hakutapa: DataFrame, pub_dim_koodisto_haunkohdejoukko: DataFrame,
    pub_dim_koodisto_haunkohdejoukontarkenne: DataFrame,
) -> DataFrame:
    """Searches with code names.  The English name shows the Swedish one."""
    rows = int_haku
    for codes, uri, name in (
        (pub_dim_koodisto_hakutapa, "hakutapakoodiuri", "hakutapa"),
        (pub_dim_koodisto_haunkohdejoukko, "kohdejoukkokoodiuri", "kohdejoukko"),
        (pub_dim_koodisto_haunkohdejoukontarkenne, "kohdejoukontarkennekoodiuri", "kohdejoukontarkenne"),
    ):
        named = pick(codes, f"versioitu_koodiuri={uri} koodiarvo={name}_koodi koodinimi={name}_nimi")
        rows = rows.join(named, [uri], "left")
    names = jsonx.translated("haku_nimi")
    return pick(
        rows.withColumns({"haku_nimi_fi": names["fi"], "haku_nimi_sv": names["sv"], "haku_nimi_en": names["sv"]}),
        """
        haku_oid haku_nimi ulkoinen_tunniste tila hakutapakoodiuri hakuajat hakutapa_koodi hakutapa_nimi
        kohdejoukkokoodiuri kohdejoukko_koodi kohdejoukko_nimi kohdejoukontarkennekoodiuri kohdejoukontarkenne_koodi
        kohdejoukontarkenne_nimi koulutuksen_alkamiskausikoodi=koulutuksen_alkamiskausi haun_tyyppi haku_nimi_fi
        haku_nimi_sv haku_nimi_en jarjestetyt_hakutoiveet=hakukohteiden_priorisointi
        """,
    )


def size_text(df_prefix: str = "opintojenlaajuusnumero") -> Column:
    """Extent of studies: one number, or 'min-max'."""
    exact, low, high = (text.plain_number(df_prefix + end) for end in ("", "min", "max"))
    same = F.col(f"{df_prefix}min") == F.col(f"{df_prefix}max")
    return F.coalesce(exact, F.when(same, low), F.concat(low, F.lit("-"), high))


@model()
def pub_dim_koulutus(
    int_kouta_koulutus: DataFrame, int_koodisto_opintojenlaajuusyksikko: DataFrame,
    int_koodisto_koulutus_alat_ja_asteet: DataFrame,
) -> DataFrame:
    """Educations; degree levels over all their codes, fields by the first."""
    levels = int_koodisto_koulutus_alat_ja_asteet
    rows = int_kouta_koulutus.withColumn("koulutus_koodi", jsonx.at("koulutuksetkoodiuri", 0))
    of_codes = (
        rows.select("koulutus_oid", F.explode(jsonx.elements("koulutuksetkoodiuri")).alias("versioitu_koodiuri"))
        .join(levels, ["versioitu_koodiuri"])
        .groupBy("koulutus_oid")
        .agg(aggregates.any_set(F.col("alempi_kk_aste")).alias("_lower"), aggregates.any_set(F.col("ylempi_kk_aste")).alias("_upper"))
    )
    fields = pick(
        levels,
        """
        versioitu_koodiuri=koulutus_koodi okm_ohjauksen_ala kansallinenkoulutusluokitus2016koulutusastetaso1
        kansallinenkoulutusluokitus2016koulutusastetaso2 kansallinenkoulutusluokitus2016koulutusalataso1
        kansallinenkoulutusluokitus2016koulutusalataso2 kansallinenkoulutusluokitus2016koulutusalataso3 jatkotutkinto laakis
        """,
    )
    units = pick(
        int_koodisto_opintojenlaajuusyksikko,
        "versioitu_koodiuri=opintojenlaajuusyksikkokoodiuri koodinimi=laajuusyksikko_nimi",
    )
    rows = (
        rows.join(of_codes, ["koulutus_oid"], "left").join(fields, ["koulutus_koodi"], "left")
        .join(units, ["opintojenlaajuusyksikkokoodiuri"], "left")
    )
    lower, upper = F.col("_lower"), F.col("_upper")
    level = (
        F.when(lower & upper, 3).when(lower & ~upper, 1).when(~lower & upper, 2)
        .when(F.col("jatkotutkinto"), 4).otherwise(5)
    )
    return pick(
        rows.withColumns(
            {
                "opintojenlaajuus": size_text(),
                "alempi_kk_aste": F.coalesce(lower, F.lit(False)),
                "ylempi_kk_aste": F.coalesce(upper, F.lit(False)),
                "kk_tutkinnon_taso": level,
            }
        ),
        """
        koulutus_oid koulutus_nimi externalid=ulkoinen_tunniste tila organisaatio_oid koulutustyyppi tarjoajat kielivalinta
        opintojenlaajuus laajuusyksikko_nimi koulutuksetkoodiuri=koulutus_koodit alempi_kk_aste ylempi_kk_aste
        koulutus_koodi okm_ohjauksen_ala kansallinenkoulutusluokitus2016koulutusastetaso1
        kansallinenkoulutusluokitus2016koulutusastetaso2 kansallinenkoulutusluokitus2016koulutusalataso1
        kansallinenkoulutusluokitus2016koulutusalataso2 kansallinenkoulutusluokitus2016koulutusalataso3 jatkotutkinto laakis
        kk_tutkinnon_taso
        """,
    )


def start_columns(document: str, last_spring_month: int) -> dict[str, Column]:
    """Kind, season code, year and personal-plan text of a start document.
    Each report has its own last month of spring for exact dates."""
    d = F.from_json(
        document,
        seasons.START_FIELDS + ", henkilokohtaisenSuunnitelmanLisatiedot string",
    )
    kind, day = d["alkamiskausityyppi"], d["koulutuksenAlkamispaivamaara"].cast("timestamp")
    dated = F.when(F.month(day) <= last_spring_month, seasons.SPRING).when(day.isNotNull(), seasons.AUTUMN)
    return {
        "koulutuksen_alkamiskausi_tyyppi": kind,
        "koulutuksen_alkamiskausi_koodiuri": F.when(kind == seasons.BY_SEASON, d["koulutuksenAlkamiskausiKoodiUri"]).when(
            kind == seasons.BY_DATE, dated
        ),
        "koulutuksen_alkamisvuosi": F.when(kind == seasons.BY_SEASON, d["koulutuksenAlkamisvuosi"].cast("int")).when(
            kind == seasons.BY_DATE, F.year(day)
        ),
        "henkilokohtaisen_suunnitelman_lisatiedot": d["henkilokohtaisenSuunnitelmanLisatiedot"],
    }


def degree_cycle() -> Column:
    """Cycle of the degree: 5 postgraduate, 1 lower, 3 higher, 6 other; of
    transfer searches 2 lower or medicine, 4 higher, -1 other."""
    lower, upper, medicine = F.col("alempi_kk_aste"), F.col("ylempi_kk_aste"), F.col("laakis")
    transfer = F.when(lower, 2).when(~lower & medicine, 2).when(~lower & upper, 4).otherwise(-1)
    return (
        F.when(F.col("jatkotutkinto"), 5).when(F.col("siirtohaku"), transfer)
        .when(lower, 1).when(~lower & upper, 3).otherwise(6)
    )


@model()
def pub_dim_hakukohde(
    int_hakukohde: DataFrame, int_kouta_toteutus: DataFrame, int_haku: DataFrame, pub_dim_koulutus: DataFrame,
    pub_dim_organisaatio: DataFrame, int_organisaatio_hakukohteiden_nimet: DataFrame,
    pub_dim_koodisto_koulutusalataso1: DataFrame,
) -> DataFrame:
    offers = pick(int_kouta_toteutus, "toteutus_oid koulutus_oid koulutuksen_alkamiskausi=_offer_start")
    searches = pick(int_haku, "haku_oid hakuajat=_search_periods siirtohaku koulutuksen_alkamiskausi=_search_start")
    educations = pick(
        pub_dim_koulutus,
        """
        koulutus_oid alempi_kk_aste ylempi_kk_aste okm_ohjauksen_ala jatkotutkinto laakis
        kansallinenkoulutusluokitus2016koulutusalataso1=koulutusala
        """,
    )
    places = pick(
        pub_dim_organisaatio,
        """
        organisaatio_oid=jarjestyspaikka_oid organisaatio_nimi=jarjestyspaikka_nimi sijaintikunta sijaintikunta_nimi
        sijaintimaakunta sijaintimaakunta_nimi
        """,
    )
    fields = pick(pub_dim_koodisto_koulutusalataso1, "koodiarvo=koulutusala koodinimi=koulutusala_nimi")
    education_of = offers.join(educations.withColumn("_known", F.lit(True)), ["koulutus_oid"], "left").withColumn(
        "koulutus_oid", F.when(F.col("_known"), F.col("koulutus_oid"))
    )
    rows = (
        int_hakukohde.join(education_of, ["toteutus_oid"], "left")
        .join(searches, ["haku_oid"], "left")
        .join(places, ["jarjestyspaikka_oid"], "left")
        .join(int_organisaatio_hakukohteiden_nimet, ["jarjestyspaikka_oid"], "left")
        .join(fields, ["koulutusala"], "left")
    )
    names = jsonx.translated("hakukohde_nimi")
    rows = rows.withColumns(
        {
            "hakuajat": F.when(F.col("kaytetaanhaunaikataulua"), F.col("_search_periods")).otherwise(F.col("hakuajat")),
            "koulutuksen_alkamiskausi": F.coalesce("koulutuksen_alkamiskausi", "_search_start", "_offer_start"),
            "tutkinnon_taso_sykli": degree_cycle(),
            "jarjestaaurheilijanammkoulutusta": F.coalesce("jarjestaaurheilijanammkoulutusta", F.lit(False)),
            **{f"hakukohde_nimi_{lang}": names[lang] for lang in ("fi", "sv", "en")},
        }
    )
    shown = pick(
        rows.withColumns(start_columns("koulutuksen_alkamiskausi", last_spring_month=7)),
        """
        hakukohde_oid hakukohde_nimi organisaatio_nimi toimipiste toimipiste_nimi oppilaitos oppilaitos_nimi koulutustoimija
        koulutustoimija_nimi ulkoinen_tunniste tila haku_oid toteutus_oid koulutus_oid jarjestyspaikka_oid
        jarjestyspaikka_nimi sijaintikunta sijaintikunta_nimi sijaintimaakunta sijaintimaakunta_nimi
        oppilaitoksen_opetuskieli hakukohteen_aloituspaikat valintaperusteiden_aloituspaikat aloituspaikat_ensikertalaisille
        hakukohdekoodiuri hakuajat kaytetaanhaunaikataulua=kaytetaan_haun_aikataulua on_valintakoe tutkinnon_taso_sykli
        koulutuksen_alkamiskausi koulutuksen_alkamiskausi_tyyppi koulutuksen_alkamiskausi_koodiuri koulutuksen_alkamisvuosi
        henkilokohtaisen_suunnitelman_lisatiedot toinenasteonkokaksoistutkinto=toinen_aste_onko_kaksoistutkinto
        jarjestaaurheilijanammkoulutusta=jarjestaa_urheilijan_ammkoulutusta alempi_kk_aste ylempi_kk_aste okm_ohjauksen_ala
        koulutusala koulutusala_nimi valintaperuste_nimi hakukohde_nimi_fi hakukohde_nimi_sv hakukohde_nimi_en
        pohjakoulutuskoodit
        """,
    )
    # the second column splits the targets of the one search that holds most
    shown = shown.withColumn("koulutuksen_alkamisvuosi", F.col("koulutuksen_alkamisvuosi").cast("double"))
    return shown.repartitionByRange("haku_oid", "hakukohde_oid").sortWithinPartitions("haku_oid")


@model()
def pub_dim_toteutus(int_kouta_toteutus: DataFrame) -> DataFrame:
    rows = int_kouta_toteutus.withColumns(start_columns("koulutuksen_alkamiskausi", last_spring_month=6))
    return pick(
        rows,
        """
        toteutus_oid toteutus_nimi tunniste=ulkoinen_tunniste tila organisaatio_oid koulutus_oid koulutuksen_alkamiskausi
        opetuskielikoodiurit=oppilaitoksen_opetuskieli suunniteltukestovuodet suunniteltukestokuukaudet
        koulutuksen_alkamiskausi_tyyppi koulutuksen_alkamiskausi_koodiuri koulutuksen_alkamisvuosi
        henkilokohtaisen_suunnitelman_lisatiedot
        """,
    )


@model()
def pub_dim_hakukohderyhma(int_hakukohderyhma_hakukohde: DataFrame) -> DataFrame:
    return int_hakukohderyhma_hakukohde.select("hakukohderyhma_oid", "hakukohderyhma_nimi").distinct()


@model()
def pub_dim_hakukohderyhma_ja_hakukohteet(int_hakukohderyhma_hakukohde: DataFrame, int_kouta_hakukohde: DataFrame) -> DataFrame:
    members = int_hakukohderyhma_hakukohde.filter("hakukohde_oid IS NOT NULL").select(
        "hakukohderyhma_id", "hakukohderyhma_oid", "hakukohde_oid"
    )
    return members.join(int_kouta_hakukohde.select("hakukohde_oid", "haku_oid"), ["hakukohde_oid"], "left")


@model()
def pub_dim_hakutoive(int_hakutoive: DataFrame) -> DataFrame:
    return int_hakutoive.drop("hakukelpoisuus_asetettu_automaattisesti").withColumn(
        "osallistui_paasykokeeseen", F.lit(None).cast("boolean")
    )


NO_SEASON = '{"type":"eialkamiskautta"}'


@model()
def pub_dim_kontrolli_haku(
    int_haku: DataFrame, int_toteutus_koulutuksen_alkamiskausi: DataFrame, int_hakukohde: DataFrame
) -> DataFrame:
    """Searches with all start seasons they lead to, as a JSON array.

    A search counts with its own season, and with that of each target; where
    the search has none, a target without one takes that of its offer.
    """
    def known(column: str = "koulutuksen_alkamiskausikoodi") -> Column:
        return F.when(F.col(column) != "{}", F.col(column))

    searches = int_haku.filter(F.col("tila") != "poistettu").select("haku_oid", "haku_nimi", "haun_tyyppi", known().alias("_own"))
    targets = int_hakukohde.select("haku_oid", "toteutus_oid", known().alias("_target"))
    offers = int_toteutus_koulutuksen_alkamiskausi.filter("haku_oid IS NOT NULL").select(
        "toteutus_oid", known().alias("_offer")
    ).distinct()
    none = F.lit(NO_SEASON)
    own = searches.select("haku_oid", F.coalesce("_own", none).alias("start"))
    led_to = (
        searches.join(targets, ["haku_oid"], "left")
        .join(offers, ["toteutus_oid"], "left")
        .select("haku_oid", F.coalesce("_target", F.when(F.col("_own").isNull(), F.col("_offer")), none).alias("start"))
    )
    lists = own.unionByName(led_to).groupBy("haku_oid").agg(
        jsonx.array_of(F.array_sort(F.collect_set("start"))).alias("koulutuksen_alkamiskausi")
    )
    return searches.join(lists, ["haku_oid"]).select("haku_oid", "haku_nimi", "koulutuksen_alkamiskausi", "haun_tyyppi")


# --- persons ---


@model()
def pub_dim_henkilo(
    int_ataru_hakemus: DataFrame, int_onr_henkilo: DataFrame, int_onr_kansalaisuus: DataFrame,
    int_onr_kansalaisuus_nimi: DataFrame, int_koodisto_kunta: DataFrame, int_koodisto_maa_2: DataFrame,
) -> DataFrame:
    """Applicants per application, described by their master record."""
    masters = pick(
        int_onr_henkilo,
        """
        henkilo_oid=master_oid etunimet sukunimi aidinkieli sukupuoli kansalaisuus=kansalaisuudet turvakielto hetu
        syntymaaika
        """,
    )
    preferred = pick(
        int_onr_kansalaisuus.filter("priorisoitu_kansalaisuus"),
        "henkilo_oid=master_oid kansalaisuus kansalaisuus_nimi kansalaisuusluokka",
    )
    towns = pick(int_koodisto_kunta.filter("viimeisin_versio"), "koodiarvo=kotikunta koodinimi=kotikunta_nimi")
    countries = pick(int_koodisto_maa_2.filter("viimeisin_versio"), "koodiarvo=asuinmaa koodinimi=asuinmaa_nimi")
    applicants = pick(
        int_ataru_hakemus,
        """
        henkilo_oid hakemus_oid lahiosoite postinumero postitoimipaikka kotikunta ulk_kunta=ulkomainen_kunta asuinmaa
        sahkoposti puhelin pohjakoulutuksen_maa_toinen_aste koulutusmarkkinointilupa valintatuloksen_julkaisulupa
        sahkoinenviestintalupa hakemusmaksun_tila
        """,
    )
    rows = (
        applicants.join(int_onr_henkilo.select("henkilo_oid", "master_oid"), ["henkilo_oid"])
        .join(masters, ["master_oid"])
        .join(preferred, ["master_oid"], "left")
        .join(towns, ["kotikunta"], "left")
        .join(countries, ["asuinmaa"], "left")
        .join(int_onr_kansalaisuus_nimi.select("henkilo_oid", "kansalaisuudet_nimi"), ["henkilo_oid"], "left")
    )
    language = F.when(F.col("aidinkieli").isin("fi", "sv"), F.col("aidinkieli")).otherwise("muu")
    return pick(
        rows.withColumns(
            {"henkilo_hakemus_id": surrogate_key("henkilo_oid", "hakemus_oid"), "aidinkieliluokka": language}
        ),
        """
        henkilo_hakemus_id henkilo_oid master_oid hakemus_oid etunimet sukunimi lahiosoite postinumero postitoimipaikka
        kotikunta kotikunta_nimi ulkomainen_kunta asuinmaa asuinmaa_nimi sahkoposti puhelin
        pohjakoulutuksen_maa_toinen_aste aidinkieli aidinkieliluokka sukupuoli koulutusmarkkinointilupa
        valintatuloksen_julkaisulupa sahkoinenviestintalupa kansalaisuus kansalaisuus_nimi kansalaisuusluokka
        kansalaisuudet kansalaisuudet_nimi turvakielto hetu syntymaaika hakemusmaksun_tila
        """,
    )


@model()
def pub_dim_oppija_henkilo(
    int_onr_henkilo: DataFrame, int_ataru_hakemus: DataFrame, int_sure_suoritus: DataFrame, int_koodisto_kunta: DataFrame
) -> DataFrame:
    """Every person who has an application or an achievement."""
    known = int_ataru_hakemus.select("henkilo_oid").distinct().union(
        int_sure_suoritus.select("henkilo_oid").distinct()
    )
    towns = int_koodisto_kunta.filter("viimeisin_versio").select(
        F.col("koodiarvo").alias("kotikunta"), jsonx.translated("koodinimi").alias("_town")
    )
    rows = joins.keep_matching(int_onr_henkilo, known, ["henkilo_oid"]).join(towns, ["kotikunta"], "left")
    return rows.select(
        F.col("henkilo_oid").alias("oppija_oid"), F.coalesce("master_oid", "henkilo_oid").alias("master_oid"), "hetu",
        F.col("sukupuoli").cast("string").alias("sukupuoli"), "syntymaaika", "sukunimi", "etunimet", "aidinkieli",
        text.strip_json_list("kansalaisuus").alias("kansalaisuus"), "turvakielto", "kotikunta",
        F.col("_town.fi").alias("kotikunta_fi"), F.col("_town.sv").alias("kotikunta_sv"),
        F.col("yksiloityvtj").alias("yksiloity"),
    )


# --- facts ---


@model(order=("haku_oid", "hakemus_oid"))
def pub_fct_hakemus(int_ataru_hakemus: DataFrame, int_pohjakoulutus: DataFrame) -> DataFrame:
    base = int_pohjakoulutus.select("hakemus_oid", F.col("pohjakoulutus").cast("string").alias("pohjakoulutus"))
    active = int_ataru_hakemus.filter(F.col("tila") != "inactivated").select(
        "hakemus_oid", "haku_oid", "tila", "henkilo_oid", "pohjakoulutus_kk", "pohjakoulutuksen_maa_toinen_aste"
    )
    return active.join(base, ["hakemus_oid"], "left")


@model()
def pub_fct_raportti_hakijat_kk(
    int_hakutoive: DataFrame, int_kouta_haku: DataFrame, int_hakutoive_kk: DataFrame, pub_dim_maksuvelvollisuus: DataFrame
) -> DataFrame:
    """Applicants to higher education.  The obligation to pay shows only for
    choices whose eligibility has been reviewed."""
    higher = int_kouta_haku.filter(F.col("haun_tyyppi") == "korkeakoulu")
    # digests do not compress, so the shuffles carry the columns that they are made of
    own = {"hakemus_oid": "_application", "hakukohde_oid": "_target"}
    reviewed = int_hakutoive_kk.select(*own, "hakukelpoisuus", "pohjakoulutus").withColumnsRenamed(own)
    obligations = pub_dim_maksuvelvollisuus.withColumnRenamed("hakutoive_id", "_choice")
    reviewed = reviewed.join(obligations, surrogate_key(*own.values()) == F.col("_choice"), "left").drop("_choice")
    choices = joins.keep_matching(int_hakutoive, higher, ["haku_oid"]).select(*own, "henkilo_oid")
    rows = choices.join(reviewed, surrogate_key(*own) == surrogate_key(*own.values()), "left").drop(*own.values())
    return rows.select(surrogate_key(*own).alias("hakutoive_id"), *[c for c in rows.columns if c not in own])


@model()
def pub_fct_raportti_hakijat_toinen_aste(
    int_ataru_hakutoive: DataFrame, int_ataru_hakemus: DataFrame, int_kouta_haku: DataFrame, int_ataru_soratietoja: DataFrame,
    int_sure_harkinnanvaraisuus: DataFrame, int_valintarekisteri_ilmoittautuminen: DataFrame,
    int_kaksoistutkinto_hakukohde: DataFrame, int_urheilijatutkinto_hakukohde: DataFrame, int_pohjakoulutus: DataFrame,
) -> DataFrame:
    secondary = int_kouta_haku.filter(F.col("haun_tyyppi") == "toinen_aste")
    applications = joins.keep_matching(int_ataru_hakemus, secondary, ["haku_oid"])
    choices = joins.keep_matching(int_ataru_hakutoive.filter("NOT poistettu"), applications, ["hakemus_oid"]).select(
        "hakutoive_id", "hakukohde_henkilo_id", "hakemus_oid", "hakukohde_oid"
    )
    rows = choices
    for table, key, columns in (
        (int_ataru_soratietoja, "hakutoive_id", ["sora_terveys", "sora_aiempi"]),
        (int_sure_harkinnanvaraisuus, "hakutoive_id", ["harkinnanvaraisuuden_syy"]),
        (int_valintarekisteri_ilmoittautuminen, "hakukohde_henkilo_id", ["tila"]),
        (int_kaksoistutkinto_hakukohde.filter("NOT poistettu"), "hakutoive_id", ["kaksoistutkinto_kiinnostaa"]),
        (int_urheilijatutkinto_hakukohde, "hakutoive_id", ["urheilijatutkinto_kiinnostaa"]),
        (int_pohjakoulutus, "hakemus_oid", ["pohjakoulutus", "pohjakoulutus_nimi"]),
    ):
        rows = rows.join(table.select(key, *columns), [key], "left")
    return rows.drop("hakukohde_henkilo_id")


# states of acceptance and enrolment (fixed values)
TAKEN = ("VASTAANOTTANUT_SITOVASTI", "EHDOLLISESTI_VASTAANOTTANUT")
NOT_ENROLLED = ("EI_TEHTY", "EI_ILMOITTAUTUNUT")
WHOLE_YEAR_PRESENT = ("LASNA", "LASNA_KOKO_LUKUVUOSI")


def accepted(overdue_too: bool = False) -> Column:
    """Whether a choice led to a study place.  One report also counts places
    that lapsed because they were not accepted in time."""
    state = F.col("valintatieto")
    not_cancelled = ~F.col("vastaanottotieto").eqNullSafe("PERUUTETTU")
    result = ((state == "HYVAKSYTTY") & not_cancelled) | ((state == "VARASIJALTA_HYVAKSYTTY") & not_cancelled)
    if overdue_too:
        result = result | ((state == "PERUUNTUNUT") & (F.col("vastaanottotieto") == "EI_VASTAANOTETTU_MAARA_AIKANA"))
    return result | (state == "PERUNUT")


def present() -> Column:
    """Present in the season in which the studies start."""
    season, state = F.col("koulutuksen_alkamiskausi_koodiuri"), F.upper("_enrolment")
    autumn = (season == seasons.AUTUMN) & state.isin("LASNA_SYKSY", "POISSA_KEVAT", *WHOLE_YEAR_PRESENT)
    spring = (season == seasons.SPRING) & state.isin("LASNA_KEVAT", "POISSA_SYKSY", *WHOLE_YEAR_PRESENT)
    return autumn | spring | state.isin(*WHOLE_YEAR_PRESENT)


def absent() -> Column:
    season, state = F.col("koulutuksen_alkamiskausi_koodiuri"), F.upper("_enrolment")
    autumn = (season == seasons.AUTUMN) & state.isin("POISSA_SYKSY", "POISSA_KOKO_LUKUVUOSI")
    spring = (season == seasons.SPRING) & state.isin("POISSA_KEVAT", "POISSA_KOKO_LUKUVUOSI")
    return autumn | spring | state.isin("POISSA", "POISSA_KOKO_LUKUVUOSI")


def enrolled() -> Column:
    return F.col("_enrolment").isNotNull() & ~F.col("_enrolment").isin(*NOT_ENROLLED)


def taken() -> Column:
    return F.col("_acceptance").isin(*TAKEN)


def wishes(numbers: int, as_count: bool) -> dict[str, Column]:
    is_nth = {f"toive_{n}": F.col("hakutoivenumero") == n for n in range(1, numbers + 1)}
    return {k: aggregates.count_where(c) for k, c in is_nth.items()} if as_count else is_nth


def register(acceptances: DataFrame, enrolments: DataFrame) -> DataFrame:
    """Acceptance and enrolment of a person's place side by side."""
    enrolled_rows = pick(enrolments, "hakukohde_henkilo_id tila=_enrolment")
    accepted_rows = pick(acceptances, "hakukohde_henkilo_id vastaanottotieto=_acceptance")
    return joins.full_on(accepted_rows, enrolled_rows, ["hakukohde_henkilo_id"])


# digests of a choice, and the columns that they are made of
CHOICE, PERSON, REGISTER = ("hakemus_oid", "hakukohde_oid"), ("henkilo_oid", "hakemus_oid"), ("hakukohde_oid", "henkilo_oid")


def bare(choices: DataFrame) -> DataFrame:
    """Choices without their digests: these do not compress, so the shuffles carry the
    columns that they are made of."""
    return choices.drop("hakutoive_id", "henkilo_hakemus_id", "hakukohde_henkilo_id")


def with_facts(choices: DataFrame, made_of: tuple[str, str], facts: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Bare choices with the rows of a table that has one of their digests as its key."""
    return choices.join(facts.withColumnRenamed(key, "_key"), surrogate_key(*made_of) == F.col("_key"), how).drop("_key")


def higher_rows(choices, targets, persons, registered, reviewed, obligations) -> DataFrame:
    """Choices in higher education with person, target, register and fee."""
    persons = pick(
        persons, "henkilo_hakemus_id master_oid aidinkieliluokka kansalaisuusluokka sukupuoli kansalaisuus"
    )
    targets = targets.select("hakukohde_oid", "koulutuksen_alkamiskausi_koodiuri")
    registered = pick(registered, "hakukohde_henkilo_id vastaanottotieto=_acceptance ilmoittautumisen_tila=_enrolment")
    # what adds least comes first; after the targets the rows are dealt by target, as the report counts them
    rows = with_facts(bare(choices), CHOICE, reviewed.select("hakutoive_id"), "hakutoive_id")
    rows = with_facts(rows, CHOICE, obligations, "hakutoive_id")
    rows = with_facts(rows, REGISTER, registered, "hakukohde_henkilo_id")
    rows = with_facts(rows, PERSON, persons, "henkilo_hakemus_id", "inner").join(targets, ["hakukohde_oid"])
    return rows.withColumn("hakutoive_id", surrogate_key(*CHOICE))


def person_class() -> list[Column]:
    """Language, citizenship class, sex, citizenship and first-timer status
    with defaults for the unknown."""
    return [
        F.col("aidinkieliluokka").alias("aidinkieli"),
        F.coalesce("kansalaisuusluokka", F.lit(3)).alias("kansalaisuusluokka"),
        F.col("sukupuoli"),
        F.coalesce("kansalaisuus", F.lit("999")).alias("kansalaisuus"),
        F.coalesce("ensikertalainen", F.lit(False)).alias("ensikertalainen"),
    ]


@model()
def pub_fct_raportti_tilastoraportti_kk(
    pub_dim_hakutoive: DataFrame, pub_dim_hakukohde: DataFrame, pub_dim_henkilo: DataFrame, int_valintarekisteri: DataFrame,
    int_hakutoive_kk: DataFrame, pub_dim_maksuvelvollisuus: DataFrame,
) -> DataFrame:
    """Statistics of higher education per target and kind of person."""
    rows = higher_rows(
        pub_dim_hakutoive, pub_dim_hakukohde, pub_dim_henkilo, int_valintarekisteri, int_hakutoive_kk, pub_dim_maksuvelvollisuus
    )
    count = aggregates.count_where
    first_timer = F.col("_first_timer")
    return rows.withColumn("_first_timer", F.col("ensikertalainen")).groupBy("hakukohde_oid", *person_class()).agg(
        F.count_distinct("henkilo_oid").alias("hakijat"),
        count(F.col("hakutoivenumero") == 1).alias("ensisijaisia"),
        count(first_timer).alias("ensikertalaisia"),
        count(accepted()).alias("hyvaksytyt"),
        count(taken()).alias("vastaanottaneet"),
        count(present()).alias("lasna"),
        count(absent()).alias("poissa"),
        count(enrolled()).alias("ilm_yht"),
        count(F.col("maksuvelvollisuus") == "obligated").alias("maksuvelvollisia"),
        *[c.alias(n) for n, c in wishes(6, as_count=True).items()],
    )


@model()
def pub_fct_raportti_tilastoraportti_kk_hakutoive(
    pub_dim_hakutoive: DataFrame, pub_dim_hakukohde: DataFrame, pub_dim_henkilo: DataFrame, int_valintarekisteri: DataFrame,
    int_hakutoive_kk: DataFrame, pub_dim_maksuvelvollisuus: DataFrame,
) -> DataFrame:
    """The same facts per choice; unknown facts stay NULL."""
    rows = higher_rows(
        pub_dim_hakutoive, pub_dim_hakukohde, pub_dim_henkilo, int_valintarekisteri, int_hakutoive_kk, pub_dim_maksuvelvollisuus
    )
    return rows.select(
        "hakutoive_id", F.col("master_oid").alias("henkilo_oid"), "hakukohde_oid", *person_class(),
        (F.col("hakutoivenumero") == 1).alias("ensisijainen"), accepted(overdue_too=True).alias("hyvaksytty"),
        taken().alias("vastaanottanut"), present().alias("lasna"), absent().alias("poissa"), enrolled().alias("ilmoittautunut"),
        (F.col("maksuvelvollisuus") == "obligated").alias("maksuvelvollinen"),
        *[c.alias(n) for n, c in wishes(6, as_count=False).items()],
    )


def secondary_rows(choices, targets, educations, persons, acceptances, enrolments) -> DataFrame:
    """Choices in secondary education with person, target, field and register."""
    fields = pick(
        educations,
        """
        koulutus_oid kansallinenkoulutusluokitus2016koulutusalataso1=koulutusalataso_1
        kansallinenkoulutusluokitus2016koulutusalataso2=koulutusalataso_2
        kansallinenkoulutusluokitus2016koulutusalataso3=koulutusalataso_3
        """,
    )
    targets = targets.select("hakukohde_oid", "koulutus_oid", "koulutuksen_alkamiskausi_koodiuri").join(fields, ["koulutus_oid"])
    persons = persons.select("henkilo_hakemus_id", "master_oid", "sukupuoli")
    rows = with_facts(bare(choices), REGISTER, register(acceptances, enrolments), "hakukohde_henkilo_id")
    rows = with_facts(rows, PERSON, persons, "henkilo_hakemus_id", "inner").join(targets, ["hakukohde_oid"])
    return rows.withColumn("hakutoive_id", surrogate_key(*CHOICE))


FIELD_KEYS = [
    "hakukohde_oid", "koulutusalataso_1", "koulutusalataso_2", "koulutusalataso_3", "harkinnanvaraisuuden_syy", "sukupuoli",
]


@model()
def pub_fct_raportti_tilastoraportti_toinen_aste(
    pub_dim_hakutoive: DataFrame, pub_dim_hakukohde: DataFrame, pub_dim_koulutus: DataFrame, pub_dim_henkilo: DataFrame,
    int_vastaanotto: DataFrame, int_valintarekisteri_ilmoittautuminen: DataFrame,
) -> DataFrame:
    """Statistics of secondary education per target, field and sex."""
    rows = secondary_rows(
        pub_dim_hakutoive, pub_dim_hakukohde, pub_dim_koulutus, pub_dim_henkilo, int_vastaanotto,
        int_valintarekisteri_ilmoittautuminen,
    )
    count = aggregates.count_where
    return rows.groupBy(*FIELD_KEYS).agg(
        F.count_distinct("henkilo_oid").alias("hakijat"),
        count(F.col("hakutoivenumero") == 1).alias("ensisijaisia"),
        count(F.col("valintatieto") == "VARALLA").alias("varasija"),
        count(accepted()).alias("hyvaksytyt"),
        count(taken()).alias("vastaanottaneet"),
        count(present()).alias("lasna"),
        count(absent()).alias("poissa"),
        count(enrolled()).alias("ilm_yht"),
        *[c.alias(n) for n, c in wishes(7, as_count=True).items()],
    )


@model()
def pub_fct_raportti_tilastoraportti_2aste_hakutoive(
    pub_dim_hakutoive: DataFrame, pub_dim_hakukohde: DataFrame, pub_dim_koulutus: DataFrame, pub_dim_henkilo: DataFrame,
    int_vastaanotto: DataFrame, int_valintarekisteri_ilmoittautuminen: DataFrame,
) -> DataFrame:
    rows = secondary_rows(
        pub_dim_hakutoive, pub_dim_hakukohde, pub_dim_koulutus, pub_dim_henkilo, int_vastaanotto,
        int_valintarekisteri_ilmoittautuminen,
    )
    return rows.select(
        "hakutoive_id", F.col("master_oid").alias("henkilo_oid"), *FIELD_KEYS,
        (F.col("hakutoivenumero") == 1).alias("ensisijainen"), (F.col("valintatieto") == "VARALLA").alias("varasija"),
        accepted().alias("hyvaksytty"), taken().alias("vastaanottanut"), present().alias("lasna"), absent().alias("poissa"),
        enrolled().alias("ilmoittautunut"), *[c.alias(n) for n, c in wishes(7, as_count=False).items()],
    )
