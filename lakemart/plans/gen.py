"""Hand-over layer: wide flat tables for other systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx, times
from lakemart.functions.keys import surrogate_key
from lakemart.plans.codes import versioned
from lakemart.plans.model import Since, add, model
from lakemart.sources.shred import LANGUAGES

STORED = "dw_metadata_dw_stored_at"


def pick(df: DataFrame, text: str) -> DataFrame:
    """Columns from words ``column[=name]``; ``column/*[=name]`` takes the
    three languages of a translated text as name_fi, name_sv and name_en."""
    chosen = []
    for word in text.split():
        column, _, name = word.partition("=")
        if column.endswith("/*"):
            column = column[:-2]
            parts = jsonx.translated(column)
            chosen += [parts[lang].alias(f"{name or column}_{lang}") for lang in LANGUAGES]
        else:
            chosen.append(F.col(column).alias(name or column))
    return df.select(*chosen)


def copy_of(table: str, name: str, columns: str | None = None, **options) -> None:
    add(name, (lambda df: pick(df, columns)) if columns else (lambda df: df), (table,), **options)


START_FIELDS = (
    "koulutuksenAlkamispaivamaara string, koulutuksenPaattymispaivamaara string, koulutuksenAlkamisvuosi string, "
    "koulutuksenAlkamiskausiKoodiUri string, henkilokohtaisenSuunnitelmanLisatiedot struct<fi: string, sv: string, en: string>"
)


def with_start(df: DataFrame, document: str) -> DataFrame:
    """The start document laid out in columns."""
    d = F.from_json(document, START_FIELDS)
    plan = d["henkilokohtaisenSuunnitelmanLisatiedot"]
    return df.withColumns(
        {
            "koulutuksen_tarkka_alkamisaika": d["koulutuksenAlkamispaivamaara"].cast("timestamp"),
            "koulutuksen_tarkka_paattymispaiva": d["koulutuksenPaattymispaivamaara"].cast("timestamp"),
            "koulutuksen_alkamisvuosi": d["koulutuksenAlkamisvuosi"].cast("int"),
            "koulutuksen_alkamiskausiuri": d["koulutuksenAlkamiskausiKoodiUri"],
            **{f"henkilokohtaisen_suunnitelman_lisatiedot_{lang}": plan[lang] for lang in LANGUAGES},
        }
    )


START_COLUMNS = """
    koulutuksen_tarkka_alkamisaika koulutuksen_tarkka_paattymispaiva koulutuksen_alkamisvuosi koulutuksen_alkamiskausiuri
    henkilokohtaisen_suunnitelman_lisatiedot_fi henkilokohtaisen_suunnitelman_lisatiedot_sv
    henkilokohtaisen_suunnitelman_lisatiedot_en
"""

# --- applications ---


@model(load="merge", keys=("hakemus_oid",), since=Since(STORED, inclusive=True, overlap="5 SECONDS"))
def gen_hakemus(int_ataru_hakemus: DataFrame) -> DataFrame:
    """Applications with citizenships as one flat array.  Applications without
    a citizenship are left out, as in the hand-over contract."""
    nested = F.from_json("kansalaisuus", "array<array<string>>")
    rows = int_ataru_hakemus.withColumn("_flat", F.flatten(F.filter(nested, lambda c: c.isNotNull()))).filter(F.size("_flat") > 0)
    return pick(
        rows.withColumn("kansalaisuus", F.to_json("_flat")),
        """
        hakemus_oid versio_id lomake_id lomakeversio_id luotu tila jatetty kieli haku_oid hakukohde henkilo_oid etunimet
        kutsumanimi sukunimi hetu lahiosoite postinumero postitoimipaikka ulk_kunta kotikunta asuinmaa sukupuoli
        kansalaisuus sahkoinenviestintalupa koulutusmarkkinointilupa valintatuloksen_julkaisulupa asiointikieli sahkoposti
        puhelin pohjakoulutuksen_maa_toinen_aste hakemusmaksut muokattu poistettu hakemusmaksun_tila
        kiinnostunut_oppisopimuksesta pohjakoulutus_kk pohjakoulutus_kk_valmistumisvuosi dw_metadata_dw_stored_at
        """,
    )


copy_of(
    "int_hakemus_tiedot", "gen_hakemus_tieto", load="replace", keys=("hakemus_oid",), since=Since(STORED, inclusive=True)
)


@model()
def gen_hakutoive(int_hakutoive: DataFrame, int_sure_haut: DataFrame) -> DataFrame:
    """Choices with the system that serves their search.  The labels follow
    the published table: listed searches read 'supa'."""
    listed = int_sure_haut.select("haku_oid").distinct().withColumn("_listed", F.lit(True))
    label = F.when(F.col("_listed"), "supa").otherwise("sure")
    return int_hakutoive.drop("hakukohde_henkilo_id", "henkilo_hakemus_id", "valintatapajonot").join(
        listed, ["haku_oid"], "left"
    ).withColumn("jarjestelma", label).drop("_listed")


copy_of("int_supa_tieto", "gen_supa_tieto", load="replace_changed", keys=("hakemus_oid",), since=Since(STORED))


@model()
def gen_henkilo(int_onr_henkilo: DataFrame, int_onr_kansalaisuus: DataFrame) -> DataFrame:
    preferred = int_onr_kansalaisuus.filter("priorisoitu_kansalaisuus").select(
        "henkilo_oid", F.col("kansalaisuus").alias("_preferred")
    )
    rows = int_onr_henkilo.join(preferred, ["henkilo_oid"], "left")
    return pick(
        rows,
        """
        henkilo_oid master_oid=oppijanumero master=on_master etunimet sukunimi hetu kotikunta syntymaaika aidinkieli
        kansalaisuus=kaikki_kansalaisuudet _preferred=kansalaisuus sukupuoli turvakielto yksiloityvtj
        """,
    )


# --- offers ---


@model()
def gen_haku(int_kouta_haku: DataFrame, int_haku: DataFrame) -> DataFrame:
    rows = with_start(int_kouta_haku, "koulutuksen_alkamiskausi").join(
        int_haku.select("haku_oid", "haku_vuosi", "haku_kausi"), ["haku_oid"], "left"
    )
    return pick(
        rows,
        f"""
        haku_oid haku_nimi/* externalid=ulkoinen_tunniste {START_COLUMNS} tila hakutapakoodiuri
        hakukohteenliittamisentakaraja=hakukohteen_liittamisen_takaraja
        hakukohteenmuokkaamisentakaraja=hakukohteen_muokkaamisen_takaraja
        hakukohteenliittajaorganisaatiot=hakukohteen_liittaja_organisaatiot ajastettujulkaisu=ajastettu_julkaisu
        ajastettuhaunjahakukohteidenarkistointi=ajastettu_haun_ja_hakukohteiden_arkistointi
        ajastettuhaunjahakukohteidenarkistointiajettu=ajastettu_haun_ja_hakukohteiden_arkistointi_ajettu
        kohdejoukkokoodiuri=kohdejoukko_koodiuri kohdejoukontarkennekoodiuri=kohdejoukon_tarkenne_koodiuri
        hakulomaketyyppi=hakulomake_tyyppi hakulomakeataruid=hakulomake_ataru_id hakulomakekuvaus/*=hakulomake_kuvaus
        hakulomakelinkki/*=hakulomake_linkki tulevaisuudenaikataulu organisaatiooid=organisaatio_oid haku_vuosi haku_kausi
        hakuajat
        """,
    )


@model()
def gen_hakukohde(int_kouta_hakukohde: DataFrame) -> DataFrame:
    start = with_start(int_kouta_hakukohde, "koulutuksenalkamiskausi")
    return pick(
        start,
        """
        hakukohde_oid toteutus_oid haku_oid jarjestyspaikka_oid ulkoinen_tunniste hakukohde_nimi/* organisaatio_oid
        valintaperuste_id tila esikatselu hakukohdekoodiuri=hakukohde_koodiuri hakulomaketyyppi=hakulomake_tyyppi
        hakulomakeataruid=hakulomake_ataru_id hakulomakekuvaus/*=hakulomake_kuvaus hakulomakelinkki/*=hakulomake_linkki
        kaytetaanhaunhakulomaketta=kaytetaan_haun_hakulomaketta
        pohjakoulutusvaatimuskoodiurit=pohjakoulutusvaatimus_koodiurit
        pohjakoulutusvaatimustarkenne/*=pohjakoulutusvaatimus_tarkenne
        muupohjakoulutusvaatimus=muu_pohjakoulutusvaatimus
        toinenasteonkokaksoistutkinto=toinen_aste_onko_kaksoistutkinto
        kaytetaanhaunaikataulua=kaytetaan_haun_aikataulua
        liitteetonkosamatoimitusaika=liitteet_onko_sama_toimitusaika
        liitteetonkosamatoimitusosoite=liitteet_onko_sama_toimitusosoite
        liitteidentoimitusaika=liitteiden_toimitusaika liitteidentoimitustapa=liitteiden_toimitustapa
        liitteidentoimitusosoite=liitteiden_toimitusosoite liitteet valintakokeet hakuajat
        valintakokeidenyleiskuvaus/*=valintakokeiden_yleiskuvaus
        valintaperusteenvalintakokeidenlisatilaisuudet=valintaperusteen_valintakokeiden_lisatilaisuudet
        kynnysehto/* kaytetaanhaunalkamiskautta=kaytetaan_haun_alkamiskautta
        koulutuksen_tarkka_alkamisaika=koulutuksen_alkamispaivamaara koulutuksen_alkamisvuosi koulutuksen_alkamiskausiuri
        aloituspaikat aloituspaikat_ensikertalaisille aloituspaikat_kuvaus/* hakukohteenlinja=hakukohteen_linja
        painotetutarvosanat=painotetut_arvosanat uudenopiskelijanurl/*=uuden_opiskelijan_url
        jarjestaaurheilijanammkoulutusta=jarjestaa_urheilijan_ammkoulutusta kielivalinta
        """,
    )


copy_of(
    "int_kouta_koulutus", "gen_koulutus",
    """
    koulutus_oid koulutus_nimi/* organisaatio_oid externalid=ulkoinen_tunniste johtaatutkintoon=johtaa_tutkintoon
    koulutustyyppi koulutuksetkoodiuri=koulutukset_koodiuri tila esikatselu tarjoajat julkinen kielivalinta sorakuvausid
    tyyppi kuvaus/*=koulutus_kuvaus lisatiedot tutkinnonosat koulutusalakoodiurit=koulutusala_koodiurit
    tutkintonimikekoodiurit=tutkintonimike_koodiurit opintojenlaajuusyksikkokoodiuri=opintojen_laajuus_yksikko_koodiuri
    opintojenlaajuusnumero=opintojen_laajuus_numero opintojenlaajuusnumeromin=opintojen_laajuus_numero_min
    opintojenlaajuusnumeromax=opintojen_laajuus_numero_max isavoinkorkeakoulutus=onko_avoin_korkeakoulutus tunniste
    opinnontyyppikoodiuri=opinnon_tyyppi_koodiuri korkeakoulutustyypit=korkeakoulutus_tyypit
    osaamisalakoodiuri=osaamisala_koodiuri erikoistumiskoulutuskoodiuri=erikoistumiskoulutus_koodiuri
    linkkieperusteisiin=linkki_eperusteisiin teemakuva eperusteid luokittelutermit
    """,
)


@model()
def gen_toteutus(int_kouta_toteutus: DataFrame) -> DataFrame:
    return pick(
        with_start(int_kouta_toteutus, "koulutuksen_alkamiskausi"),
        f"""
        toteutus_oid toteutus_nimi/* koulutus_oid organisaatio_oid {START_COLUMNS} externalid=ulkoinen_tunniste tila
        esikatselu tarjoajat tyyppi kuvaus_fi=toteutus_kuvaus_fi kuvaus_sv=toteutus_kuvaus_sv kuvaus_en=toteutus_kuvaus_en
        osaamisalat opetuskielikoodiurit=opetuskieli_koodiurit opetuskieletkuvaus_fi=opetuskielet_kuvaus_fi
        opetuskieletkuvaus_sv=opetuskielet_kuvaus_sv opetuskieletkuvaus_en=opetuskielet_kuvaus_en
        opetusaikakoodiurit=opetusaika_koodiurit opetusaikakuvaus/*=opetusaika_kuvaus
        opetustapakoodiurit=opetustapa_koodiurit opetustapakuvaus=opetustapa_kuvaus
        maksullisuustyyppi=maksullisuus_tyyppi maksullisuuskuvaus/*=maksullisuus_kuvaus maksunmaara=maksun_maara
        lisatiedot/*=toteutus_lisatiedot onkoapuraha=onko_apuraha suunniteltukestovuodet=suunniteltu_kesto_vuodet
        suunniteltukestokuukaudet=suunniteltu_kesto_kuukaudet suunniteltukestokuvaus/*=suunniteltu_kesto_kuvaus asiasanat
        ammattinimikkeet ishakukohteetkaytossa=onko_hakukohteet_kaytossa hakutermi hakulomaketyyppi=hakulomake_tyyppi
        hakulomakelinkki=hakulomake_linkki lisatietoahakeutumisesta/*=lisatietoa_hakeutumisesta
        lisatietoavalintaperusteista/*=lisatietoa_valintaperusteista hakuaika aloituspaikat
        aloituspaikkakuvaus/*=aloituspaikka_kuvaus isavoinkorkeakoulutus=onko_avoin_korkeakoulutus tunniste
        opinnontyyppikoodiuri=opinnon_tyyppi_koodiuri liitetytopintojaksot=liitetyt_opintojaksot
        ammatillinenperustutkintoerityisopetuksena=ammatillinen_perustutkinto_erityisopetuksena
        opintojenlaajuusyksikkokoodiuri=opintojen_laajuus_yksikko_koodiuri
        opintojenlaajuusnumero=opintojen_laajuus_numero hasjotparahoitus=on_jotpa_rahoitus
        istaydennyskoulutus=onko_taydennyskoulutus istyovoimakoulutus=onko_tyovoimakoulutus kielivalikoima yleislinja
        painotukset erityisetkoulutustehtavat=erityiset_koulutustehtavat diplomit
        jarjestetaanerityisopetuksena=jarjestetaan_erityisopetuksena taiteenalakoodiurit=taiteenala_koodiurit
        sorakuvausid=sorakuvaus_id kielivalinta teemakuva ispieniosaamiskokonaisuus=onko_pieni_osaamiskokonaisuus
        """,
    )


# --- registers ---

copy_of(
    "int_koodisto_koodi", "gen_koodi",
    """
    versioitu_koodiuri koodistouri koodiuri koodiarvo koodiversio nimi_fi nimi_sv nimi_en tila voimassaalkupvm
    voimassaloppupvm
    """,
)


@model()
def gen_koodirelaatio(int_koodisto_relaatio: DataFrame) -> DataFrame:
    return int_koodisto_relaatio.select(
        versioned("alakoodiuri", "alakoodiversio").alias("versioitu_alakoodiuri"),
        versioned("ylakoodiuri", "ylakoodiversio").alias("versioitu_ylakoodiuri"), "relaatiotyyppi", "relaatioversio",
        "alakoodiuri", "alakoodiversio", "ylakoodiuri", "ylakoodiversio",
    )


copy_of(
    "int_organisaatio_organisaatio", "gen_organisaatio",
    """
    organisaatio_oid nimi_fi nimi_sv alkupvm lakkautuspvm tila ylempi_organisaatio ylin_organisaatio organisaatiotyypit
    sijaintikunta opetuskielet oppilaitostyyppi oppilaitosnumero
    """,
)


@model()
def gen_ohjausparametri_haku(int_ohjausparametrit_parameter: DataFrame) -> DataFrame:
    """Parameters of a search as rows; a value may be plain, a time, or a period."""
    rows = int_ohjausparametrit_parameter.select("haku_oid", F.explode(jsonx.entries("arvot")).alias("avain", "alkuperainen_arvo"))
    return rows.select(
        surrogate_key("haku_oid", "avain").alias("hakuoid_avain_id"), "haku_oid", "avain", "alkuperainen_arvo",
        jsonx.at("alkuperainen_arvo", "value").alias("arvo"),
        *[
            times.from_millis(jsonx.at("alkuperainen_arvo", key)).alias(name)
            for key, name in (("date", "aikaleima"), ("dateStart", "aikaleima_alkaa"), ("dateEnd", "aikaleima_paattyy"))
        ],
    )


# --- selection ---


@model()
def gen_valinnanvaihe(int_valintaperusteet_hakukohde: DataFrame) -> DataFrame:
    phases = jsonx.records(
        "valinnanvaiheet",
        "valinnanVaiheOid string, nimi string, valinnanVaiheJarjestysluku int, aktiivinen boolean, valinnanVaiheTyyppi string",
    )
    rows = int_valintaperusteet_hakukohde.select("hakukohde_oid", F.explode(phases).alias("p"))
    return rows.select(
        F.col("p.valinnanVaiheOid").alias("valinnanvaihe_id"), "hakukohde_oid", F.col("p.nimi").alias("valinnanvaihe_nimi"),
        F.col("p.valinnanVaiheJarjestysluku").alias("valinnanvaihe_jarjestysluku"),
        F.col("p.aktiivinen").alias("valinnanvaihe_aktiivinen"), F.col("p.valinnanVaiheTyyppi").alias("valinnanvaihe_tyyppi"),
    )


copy_of("int_valintaperusteet_valintakoe", "gen_valintakoe")
copy_of("int_valintaperusteet_valintatapajono", "gen_valintaperuste_valintatapajono")


@model()
def gen_valintarekisteri(
    int_valintarekisteri_valinnantulos: DataFrame, int_valintarekisteri_jonosija: DataFrame,
    int_valintarekisteri_hyvaksyttyjulkaistuhakutoive: DataFrame, int_valintarekisteri_lukuvuosimaksu: DataFrame,
    int_valintarekisteri_ilmoittautuminen: DataFrame, int_valintarekisteri_vastaanotto: DataFrame,
) -> DataFrame:
    """Results with place in the queue, publication, fee, enrolment and acceptance."""
    person = ["henkilo_oid", "hakukohde_oid"]
    rows = int_valintarekisteri_valinnantulos.join(
        pick(
            int_valintarekisteri_jonosija,
            """
            hakemus_oid valintatapajono_oid hyvaksytty_harkinnanvaraisesti jonosija varasijan_numero
            onko_muuttunut_viime_sijoittelussa prioriteetti pisteet siirtynyt_toisesta_valintatapajonosta sijoitteluajo_id
            """,
        ),
        ["hakemus_oid", "valintatapajono_oid"], "left",
    )
    register = "henkilo_oid hakukohde_oid"
    for table, columns in (
        (int_valintarekisteri_hyvaksyttyjulkaistuhakutoive, f"{register} hyvaksyttyjajulkaistu"),
        (int_valintarekisteri_lukuvuosimaksu, f"{register} maksun_tila"),
        (int_valintarekisteri_ilmoittautuminen, f"{register} ilmoittaja=ilmoitus_ilmoittaja selite tila=ilmoituksen_tila"),
        (
            int_valintarekisteri_vastaanotto,
            f"{register} ilmoittaja=vastaanotto_ilmoittaja selite=vastaanotto_selite operaatio=vastaanotto_tila",
        ),
    ):
        rows = rows.join(pick(table, columns), person, "left")
    return pick(
        rows,
        """
        hakukohde_oid valintatapajono_oid=valintatapajono_id hakemus_oid henkilo_oid valinnan_tila
        ehdollisesti_hyvaksyttavissa ehdollisen_hyvaksymisen_ehto/* valinnantilan_kuvauksen_teksti/*=valinnantila_kuvaus
        julkaistavissa hyvaksyperuuntunut valintatiedon_pvm hyvaksytty_harkinnanvaraisesti jonosija varasijan_numero
        onko_muuttunut_viime_sijoittelussa prioriteetti pisteet siirtynyt_toisesta_valintatapajonosta sijoitteluajo_id
        hyvaksyttyjajulkaistu maksun_tila ilmoitus_ilmoittaja selite ilmoituksen_tila vastaanotto_ilmoittaja
        vastaanotto_selite vastaanotto_tila
        """,
    )


copy_of(
    "int_valintarekisteri_valintatapajono", "gen_valintarekisteri_valintatapajono",
    """
    valintatapajono_oid=valintatapajono_id valintatapajono_nimi hakukohde_oid
    alinhyvaksyttypistemaara=alin_hyvaksytty_pistemaara alkuperaisetaloituspaikat=alkuperaiset_aloituspaikat aloituspaikat
    eivarasijatayttoa=ei_varasijatayttoa hakeneet kaikkiehdontayttavathyvaksytaan=kaikki_ehdon_tayttavat_hyvaksytaan
    poissaolevataytto=poissaoleva_taytto prioriteetti
    sijoiteltuilmanvarasijasaantojaniidenollessavoimassa=sijoiteltu_ilman_varasijasaanto_ja_niidenollessa_voimassa
    tasasijasaanto valintaesityshyvaksytty=valintaesitys_hyvaksytty varasijantayttopaivat=varasijan_tayttopaivat varasijat
    varasijojakaytetaanasti=varasijoja_kaytetaan_asti
    """,
)
