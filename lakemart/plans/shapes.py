"""Field lists of the source documents (fixed values)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx, times
from lakemart.sources.shred import Shape, fields

SHAPES: dict[str, Shape] = {}


def shape(raw: str, text: str, **options) -> None:
    SHAPES[raw] = Shape(raw=raw, fields=fields(text), **options)


def comma_list(value: str) -> Column:
    """Comma-separated text as a JSON array; empty text is an empty array."""
    return F.when(F.col(value) == "", F.lit("[]")).otherwise(F.to_json(F.split(value, ",")))


def yes(value: Column) -> Column:
    return F.lower(value) == "kyllä"


def shifted(*columns: str):
    """Epoch milliseconds whose UTC clock is meant as Helsinki time."""
    return lambda df, now: {c: times.helsinki_wall_clock(times.from_millis(f"{c}_ms")) for c in columns}


# --- applications and forms ---

MALE, FEMALE = ("mies", "male", "man"), ("nainen", "female", "kvinna")


def application_details(df: DataFrame, now: Column) -> dict[str, Column]:
    gender = F.lower("gender")
    return {
        "sukupuoli": F.when(gender == "", F.lit(None)).when(gender.isin(*MALE), 1).when(gender.isin(*FEMALE), 2)
        .otherwise(F.col("gender").cast("int")),
        "sahkoinenviestintalupa": yes(F.coalesce("lupa_1", "lupa_2")),
        "koulutusmarkkinointilupa": yes(F.col("lupa_3")),
        "valintatuloksen_julkaisulupa": yes(F.col("lupa_4")),
        "asiointikieli": F.nullif("asiointikieli_text", F.lit("")).cast("int"),
    }


shape(
    "ataru_hakemus",
    """
    hakemusOid=oid id:int=versio_id form_key:uuid=lomake_id form:int=lomakeversio_id keyValues:json=tiedot
    attachments:json=liitteet created_time:time=luotu state=tila submitted:time=jatetty lang=kieli
    application_hakukohde_reviews:json=kasittelymerkinnat hakuOid=haku_oid hakukohde:json person_oid=henkilo_oid
    eligibility-set-automatically:json=hakukelpoisuus_asetettu_automaattisesti
    keyValues/first-name=etunimet keyValues/preferred-name=kutsumanimi keyValues/last-name=sukunimi keyValues/ssn=hetu
    keyValues/address=lahiosoite keyValues/postal-code=postinumero keyValues/postal-office=postitoimipaikka
    keyValues/city=ulk_kunta keyValues/home-town=kotikunta keyValues/country-of-residence=asuinmaa keyValues/gender
    keyValues/nationality:json=kansalaisuus keyValues/sahkoisen-asioinnin-lupa=lupa_1
    keyValues/paatos-opiskelijavalinnasta-sahkopostiin=lupa_2 keyValues/koulutusmarkkinointilupa=lupa_3
    keyValues/valintatuloksen-julkaisulupa=lupa_4 keyValues/asiointikieli=asiointikieli_text keyValues/email=sahkoposti
    keyValues/phone=puhelin keyValues/secondary-completed-base-education–country=pohjakoulutuksen_maa_toinen_aste
    applicationPaymentState:json=hakemusmaksut modified_time:time=muokattu
    """,
    key=("hakemus_versio_id", ("oid", "versio_id")),
    derive=application_details,
    drop=("gender", "lupa_1", "lupa_2", "lupa_3", "lupa_4", "asiointikieli_text"),
)

# questions about a double degree or an athlete's degree
SPECIAL_QUESTIONS = (
    "1dc3311d-2235-40d6-88d2-de2bd63e087b",
    "ammatillinen_perustutkinto_urheilijana",
    "4fe08958-c0b7-4847-8826-e42503caa662",
    "32b8440f-d6f0-4a8b-8f67-873344cc3488",
    "lukio_opinnot_ammatillisen_perustutkinnon_ohella",
    "ammatilliset_opinnot_lukio_opintojen_ohella",
)

shape(
    "ataru_lomake",
    """
    key:uuid=id id:int=versio_id deleted=poistettu name/*=nimi languages:json=kielivalinta
    organization-oid=organisaatio_oid created-time:time=muokattu created-by=luoja flat-content:json=content
    """,
    key=("lomake_id_versioid_id", ("id", "versio_id")),
    derive=lambda df, now: {
        "kaksois_urheilija_tutkinto": F.exists(
            jsonx.records("content", "id string"), lambda q: F.coalesce(q["id"].isin(*SPECIAL_QUESTIONS), F.lit(False))
        )
    },
)

# --- education offers ---

shape("kouta_ammattinimike", "kieli arvo")
shape("kouta_asiasana", "kieli arvo")
shape(
    "kouta_haku",
    """
    oid externalId tila nimi/* hakutapaKoodiUri hakukohteenLiittamisenTakaraja:time hakukohteenMuokkaamisenTakaraja:time
    hakukohteenLiittajaOrganisaatiot:json ajastettuJulkaisu:time ajastettuHaunJaHakukohteidenArkistointi:time
    ajastettuHaunJaHakukohteidenArkistointiAjettu:time kohdejoukkoKoodiUri kohdejoukonTarkenneKoodiUri hakulomaketyyppi
    hakulomakeAtaruId hakulomakeKuvaus:json hakulomakeLinkki:json metadata/yhteyshenkilot:json
    metadata/tulevaisuudenAikataulu:json metadata/isMuokkaajaOphVirkailija metadata/koulutuksenAlkamiskausi:json
    organisaatioOid hakuajat:json muokkaaja kielivalinta:json modified:time=muokattu enrichedData/muokkaajanNimi
    """,
)
shape(
    "kouta_hakukohde",
    """
    oid externalId toteutusOid hakuOid tila esikatselu:bool hakukohdeKoodiUri jarjestyspaikkaOid hakulomaketyyppi
    hakulomakeAtaruId hakulomakeKuvaus:json hakulomakeLinkki:json kaytetaanHaunHakulomaketta:bool
    pohjakoulutusvaatimusKoodiUrit:json pohjakoulutusvaatimusTarkenne:json muuPohjakoulutusvaatimus:json
    toinenAsteOnkoKaksoistutkinto:bool kaytetaanHaunAikataulua:bool valintaperusteId:uuid
    liitteetOnkoSamaToimitusaika:bool liitteetOnkoSamaToimitusosoite:bool liitteidenToimitusaika:time
    liitteidenToimitustapa liitteidenToimitusosoite:json liitteet:json valintakokeet:json hakuajat:json
    metadata/valintakokeidenYleiskuvaus:json metadata/valintaperusteenValintakokeidenLisatilaisuudet:json
    metadata/kynnysehto:json metadata/kaytetaanHaunAlkamiskautta:bool metadata/koulutuksenAlkamiskausi:json
    metadata/aloituspaikat/lukumaara:int=aloituspaikat
    metadata/aloituspaikat/ensikertalaisille:int=aloituspaikat_ensikertalaisille
    metadata/aloituspaikat/kuvaus:json=aloituspaikat_kuvaus metadata/hakukohteenLinja:json
    metadata/painotetutArvosanat:json metadata/uudenOpiskelijanUrl:json metadata/isMuokkaajaOphVirkailija:bool
    metadata/jarjestaaUrheilijanAmmKoulutusta:bool muokkaaja organisaatioOid kielivalinta:json modified:time=muokattu
    enrichedData/esitysnimi/*=nimi enrichedData/muokkaajanNimi
    """,
    derive=lambda df, now: {
        "esikatselu": F.coalesce("esikatselu", F.lit(False)),
        "kaytetaanhaunhakulomaketta": F.coalesce("kaytetaanhaunhakulomaketta", F.lit(False)),
    },
)
shape(
    "kouta_koulutus",
    """
    oid externalId johtaaTutkintoon:bool koulutustyyppi koulutuksetKoodiUri:json tila esikatselu:bool tarjoajat:json
    julkinen:bool kielivalinta:json sorakuvausId metadata/tyyppi metadata/kuvaus:json metadata/lisatiedot:json
    metadata/tutkinnonOsat:json metadata/koulutusalaKoodiUrit:json metadata/tutkintonimikeKoodiUrit:json
    metadata/opintojenLaajuusyksikkoKoodiUri metadata/opintojenLaajuusNumero:float
    metadata/opintojenLaajuusNumeroMin:float metadata/opintojenLaajuusNumeroMax:float
    metadata/isAvoinKorkeakoulutus:bool metadata/tunniste metadata/opinnonTyyppiKoodiUri
    metadata/korkeakoulutustyypit:json metadata/isMuokkaajaOphVirkailija:bool metadata/osaamisalaKoodiUri
    metadata/erikoistumiskoulutusKoodiUri metadata/linkkiEPerusteisiin:json metadata/luokittelutermit:json muokkaaja
    organisaatioOid teemakuva ePerusteId:int modified:time=muokattu enrichedData/esitysnimi/*=nimi muokkaajanNimi
    """,
)
shape(
    "kouta_oppilaitoksetjaosat",
    """
    oid parentOppilaitosOid tila esikatselu:bool metadata/tietoaOpiskelusta:json metadata/esittelyvideo:json
    metadata/some:json=metadata_some metadata/hakijapalveluidenYhteystiedot:json metadata/esittely/*
    metadata/korkeakouluja:int metadata/tiedekuntia:int metadata/kampuksia:int metadata/yksikoita:int
    metadata/toimipisteita:int metadata/akatemioita:int metadata/opiskelijoita:int
    metadata/isMuokkaajaOphVirkailija:bool metadata/jarjestaaUrheilijanAmmKoulutusta:bool metadata/kampus:json
    teemakuva logo kielivalinta:json organisaatioOid muokkaaja modified:time=muokattu enrichedData/muokkaajanNimi
    """,
    # read from a path that no document has, so always NULL
    derive=lambda df, now: {
        f"wwwsivu_{part}": F.lit(None).cast("string")
        for part in ("nimi_fi", "url_fi", "nimi_svi", "url_sv", "nimi_en", "url_en")
    },
)
shape(
    "kouta_pistehistoria",
    """
    tarjoaja hakukohdekoodi pisteet:float vuosi:int valintatapajonoOid hakukohdeOid hakuOid valintatapajonoTyyppi
    aloituspaikat:int ensisijaisestiHakeneet:int modified:time=muokattu
    """,
    key=("id", ("tarjoaja", "hakukohdekoodi", "vuosi")),
)
shape(
    "kouta_sorakuvaus",
    """
    id:uuid externalId tila nimi/* koulutustyyppi kielivalinta:json metadata/kuvaus/* metadata/koulutusalaKoodiUri
    metadata/koulutusKoodiUrit:json metadata/isMuokkaajaOphVirkailija:bool organisaatioOid muokkaaja
    modified:time=muokattu enrichedData/muokkaajanNimi
    """,
)
shape(
    "kouta_toteutus",
    """
    oid externalId koulutusOid tila esikatselu:bool tarjoajat:json metadata/tyyppi metadata/kuvaus/*
    metadata/osaamisalat:json metadata/opetus/opetuskieliKoodiUrit:json metadata/opetus/opetuskieletKuvaus/*
    metadata/opetus/opetusaikaKoodiUrit:json metadata/opetus/opetusaikaKuvaus:json
    metadata/opetus/opetustapaKoodiUrit:json metadata/opetus/opetustapaKuvaus:json metadata/opetus/maksullisuustyyppi
    metadata/opetus/maksullisuusKuvaus:json metadata/opetus/maksunMaara:float
    metadata/opetus/koulutuksenAlkamiskausi:json metadata/opetus/lisatiedot:json metadata/opetus/onkoApuraha:bool
    metadata/opetus/suunniteltuKestoVuodet:int metadata/opetus/suunniteltuKestoKuukaudet:int
    metadata/opetus/suunniteltuKestoKuvaus:json metadata/asiasanat:json metadata/ammattinimikkeet:json
    metadata/yhteyshenkilot:json metadata/isHakukohteetKaytossa:bool metadata/hakutermi metadata/hakulomaketyyppi
    metadata/hakulomakeLinkki:json metadata/lisatietoaHakeutumisesta:json metadata/lisatietoaValintaperusteista:json
    metadata/hakuaika:json metadata/aloituspaikat:int metadata/aloituspaikkakuvaus:json
    metadata/isAvoinKorkeakoulutus:bool metadata/tunniste metadata/opinnonTyyppiKoodiUri
    metadata/liitetytOpintojaksot:json metadata/ammatillinenPerustutkintoErityisopetuksena
    metadata/opintojenLaajuusyksikkoKoodiUri metadata/opintojenLaajuusNumero:float metadata/hasJotpaRahoitus:bool
    metadata/isTaydennyskoulutus:bool metadata/isTyovoimakoulutus:bool metadata/isMuokkaajaOphVirkailija:bool
    metadata/kielivalikoima:json metadata/yleislinja:bool metadata/painotukset:json
    metadata/erityisetKoulutustehtavat:json metadata/diplomit:json metadata/jarjestetaanErityisopetuksena:bool
    metadata/taiteenalaKoodiUrit:json metadata/isPieniOsaamiskokonaisuus:bool sorakuvausId muokkaaja organisaatioOid
    kielivalinta:json teemakuva:json modified:time=muokattu enrichedData/esitysnimi/*=nimi enrichedData/muokkaajanNimi
    """,
    # kept as JSON text, quotes included
    derive=lambda df, now: {"sorakuvausid": F.concat(F.lit('"'), F.col("sorakuvausid"), F.lit('"'))},
)
shape(
    "kouta_valintaperuste",
    """
    id:uuid externalId tila esikatselu:bool koulutustyyppi hakutapaKoodiUri kohdejoukkoKoodiUri nimi/* julkinen:bool
    valintakokeet:json metadata/tyyppi metadata/sisalto:json metadata/valintatavat:json metadata/kuvaus/*
    medatata/hakukelpoisuus:json medatata/lisatiedot:json medatata/valintakokeidenYleiskuvaus:json
    metadata/isMuokkaajaOphVirkailija organisaatioOid muokkaaja kielivalinta:json modified:time=muokattu
    enrichedData/muokkaajanNimi
    """,
)
shape("koutalight_koulutus", "id:uuid=koulutus_id updatedAt:time=muokattu", keep_document=True)
shape(
    "hakukohderyhmapalvelu_ryhma",
    """
    hakukohderyhma-oid=oid hakukohde-oids:json=hakukohde_oid settings/rajaava:bool
    settings/max-hakukohteet:int=max_hakukohteet
    settings/yo-amm-autom-hakukelpoisuus:bool=yo_amm_autom_hakukelpoisuus
    settings/jos-ylioppilastutkinto-ei-muita-pohjakoulutusliitepyyntoja:bool=jos_ylioppilastutkinto_ei_muita_pohjakoulutusliitepyyntoja
    settings/priorisoiva:bool settings/prioriteettijarjestys:json last-modified:time=muokattu
    """,
)
shape(
    "ohjausparametrit_parameter",
    """
    key=haku_oid lastModified:time=muokattu values/PH_OPVP/date:bigint=paattyy_ms
    values/PH_HPVOA/value:int=hakijakohtainen_paikan_vastaanottoaika values/sijoittelu:bool
    values/useitaHakemuksia:bool=useita_hakemuksia values/jarjestetytHakutoiveet:bool=jarjestetyt_hakutoiveet
    values/hakutoiveidenEnimmaismaara:int=hakutoiveiden_enimmaismaara
    values/hakutoiveidenMaaraRajoitettu:bool=hakutoiveiden_maara_rajoitettu values:json=arvot
    """,
    derive=lambda df, now: {"vastaanotto_paattyy": times.from_millis("paattyy_ms")},
    drop=("paattyy_ms",),
)

# --- achievements, first source ---

shape(
    "sure_arvosana",
    """
    resourceId suoritus arvosana asteikko aine lisatieto valinnainen:bool inserted:bigint=muokattu_ms deleted:bool
    pisteet myonnetty:time source jarjestys lahdeArvot/arvot
    """,
    derive=shifted("muokattu"),
    drop=("muokattu_ms",),
)
shape(
    "sure_ensikertalainen",
    """
    hakuOid henkiloOid isEnsikertalainen:bool menettamisenPeruste/peruste=menettamisenperuste
    menettamisenPeruste/paivamaara:time=menettamisenpaivamaara
    """,
)
shape("sure_harkinnanvaraisuus", "hakemusOid hakutoiveet:json")
shape(
    "sure_opiskelija",
    """
    resourceId oppilaitosOid luokkataso luokka henkiloOid alkuPaiva:bigint=alkupaiva_ms loppuPaiva:bigint=loppupaiva_ms
    inserted:bigint=muokattu_ms deleted:bool=poistettu source
    """,
    derive=shifted("alkupaiva", "loppupaiva", "muokattu"),
    drop=("alkupaiva_ms", "loppupaiva_ms", "muokattu_ms"),
)
shape(
    "sure_opiskeluoikeus",
    """
    resourceId alkuPaiva:bigint=alkupaiva_ms loppuPaiva:bigint=loppupaiva_ms henkiloOid komo myontaja source
    inserted:bigint=muokattu_ms deleted:bool=poistettu
    """,
    derive=shifted("alkupaiva", "loppupaiva", "muokattu"),
    drop=("alkupaiva_ms", "loppupaiva_ms", "muokattu_ms"),
)
shape("sure_proxysuoritus", "hakemusOid hakuOid henkiloOid values:json=keyvalues")
shape(
    "sure_suoritus",
    """
    resourceId komo myontaja tila valmistuminen:time henkiloOid yksilollistaminen suoritusKieli
    inserted:bigint=muokattu_ms deleted:bool=poistettu source vahvistettu:bool lahdeArvot/arvot
    """,
    derive=shifted("muokattu"),
    drop=("muokattu_ms",),
)

# --- selection ---


def one_row_per_score(raw: DataFrame) -> DataFrame:
    score = F.explode(jsonx.elements(jsonx.at("data", "pisteet")))
    return raw.withColumn("hakemus_oid", jsonx.at("data", "hakemusOID")).withColumn("data", score)


SCORE = dict(
    text="tunniste=valintakoe_tunniste arvo osallistuminen tallettaja poistettu:bool last_modified:time=muokattu",
    key=("valintakoe_hakemus_id", ("hakemus_oid", "valintakoe_tunniste")),
    before=one_row_per_score,
    derive=lambda df, now: {"hakemus_oid": F.col("hakemus_oid"), "muokattu": F.coalesce("muokattu", now)},
)
shape("valintalaskenta_pistetieto", **SCORE)
shape("valintapiste_service_pistetieto", **SCORE)


def local_time(value: str) -> Column:
    """Times such as 'Nov 5, 2024, 9:15:02 AM', whose space before AM may be a
    narrow no-break space, or ISO times."""
    plain = F.regexp_replace(value, "[\\u202f]+", " ")
    return F.coalesce(
        F.try_to_timestamp(plain, F.lit("MMM d, yyyy, h:mm:ss a")),
        F.try_to_timestamp(plain, F.lit("MMM d, yyyy h:mm:ss a")),
        plain.cast("timestamp"),
    )


shape(
    "valintalaskenta_valintakoe_osallistuminen",
    "hakemusOid hakutoiveet:json createdAt",
    derive=lambda df, now: {"muokattu": local_time("createdat")},
    drop=("createdat",),
)
shape(
    "valintalaskenta_valintalaskennan_tulos",
    """
    valinnanvaiheoid=valinnanvaihe_id hakuOid jarjestysnumero:int nimi valinnanvaihe:int valintakokeet:json
    valintatapajonot:json createdAt:time=muokattu
    """,
)
shape(
    "valintaperusteet_avain",
    "hakukohdeOid=hakukohde_oid",
    derive=lambda df, now: {"muokattu": now},
    keep_document=True,
)
shape(
    "valintaperusteet_hakukohde",
    """
    hakukohdeOid=hakukohde_oid hakuOid=haku_oid lastModified:time=muokattu tarjoajaOid=tarjoaja_oid
    hakukohteenValintaperuste:json valinnanVaiheet:json
    """,
)

# --- selection register ---

TARGET_PERSON = ("hakukohde_henkilo_id", ("hakukohde_oid", "henkilo_oid"))

shape(
    "valintarekisteri_hyvaksyttyjulkaistuhakutoive",
    """
    hakukohdeOid=hakukohde_oid henkiloOid=henkilo_oid hyvaksyttyJaJulkaistu:time ilmoittaja selite
    systemTime:time=muokattu
    """,
    key=TARGET_PERSON,
)
shape(
    "valintarekisteri_ilmoittautuminen",
    "hakukohdeOid=hakukohde_oid henkiloOid=henkilo_oid ilmoittaja selite tila timestamp:time=muokattu",
    key=("ilmoittautuminen_id", ("hakukohde_oid", "henkilo_oid")),
)
shape(
    "valintarekisteri_jonosija",
    """
    hakemusOid=hakemus_oid hakukohdeOid=hakukohde_oid valintatapajonoOid=valintatapajono_oid
    hyvaksyttyHarkinnanvaraisesti:bool=hyvaksytty_harkinnanvaraisesti jonosija:int varasijanNumero:int=varasijan_numero
    onkoMuuttunutViimeSijoittelussa:bool=onko_muuttunut_viime_sijoittelussa prioriteetti:int pisteet:float
    siirtynytToisestaValintatapajonosta:bool=siirtynyt_toisesta_valintatapajonosta sijoitteluajoId=sijoitteluajo_id
    systemTime:time=muokattu tasasijaJonosija:int=tasasija_jonosija tila
    """,
    key=("jonosija_id", ("hakemus_oid", "valintatapajono_oid")),
)
shape(
    "valintarekisteri_lukuvuosimaksu",
    """
    hakukohdeOid=hakukohde_oid personOid=henkilo_oid maksuntila=maksun_tila muokkaaja luotu:time=muokattu
    systemTime:time=luontihetki
    """,
    key=TARGET_PERSON,
)
shape(
    "valintarekisteri_valinnantulos",
    """
    hakukohdeOid=hakukohde_oid valintatapajonoOid=valintatapajono_oid hakemusOid=hakemus_oid henkiloOid=henkilo_oid
    valinnantila ehdollisestiHyvaksyttavissa:bool ehdollisenHyvaksymisenEhtoFi ehdollisenHyvaksymisenEhtoSv
    ehdollisenHyvaksymisenEhtoEn valinnantilanKuvauksenTekstiFI valinnantilanKuvauksenTekstiSV
    valinnantilanKuvauksenTekstiEN julkaistavissa:bool hyvaksyttyVarasijalta hyvaksyPeruuntunut:bool
    valinnantilanViimeisinMuutos:time muokattu:time
    """,
    key=("valinnantulos_id", ("hakukohde_oid", "valintatapajono_oid", "hakemus_oid")),
)
shape(
    "valintarekisteri_valintatapajono",
    """
    oid hakukohdeOid=hakukohde_oid alinHyvaksyttyPistemaara:float alkuperaisetAloituspaikat:int aloituspaikat:int
    eiVarasijatayttoa:bool hakeneet:int kaikkiEhdonTayttavatHyvaksytaan:bool nimi poissaOlevaTaytto:bool
    prioriteetti:int sijoiteltuIlmanVarasijasaantojaNiidenOllessaVoimassa:bool tasasijasaanto
    valintaesitysHyvaksytty:bool varasijanTayttoPaivat:int varasijat:int varasijojaKaytetaanAsti:time
    """,
    key=("valintatapajono_id", ("oid", "hakukohde_oid")),
)
shape(
    "valintarekisteri_vastaanotto",
    """
    hakukohdeOid=hakukohde_oid henkiloOid=henkilo_oid ilmoittaja selite action=operaatio id:int timestamp:time=muokattu
    deletedAt:time=poistettu_aikaleima deletedBy=poistaja deletedSelite=selite_poisto
    """,
    key=TARGET_PERSON,
)

# --- achievements, second source ---

shape("supa_ensikertalainen", "hakemusOid=hakemus_oid", keep_document=True)
shape("supa_harkinnanvaraisuus", "hakemusOid=hakemus_oid", keep_document=True)
shape("supa_opiskeluoikeus", "henkiloOid=henkilo_oid metadata/parserointiHetki:time=aikaleima", keep_document=True)
shape("supa_valintadata", "hakemusOid=hakemus_oid", keep_document=True)

# --- shared registers ---

shape(
    "koodisto_koodi",
    """
    koodiarvo koodinimi_fi koodinimi_sv koodinimi_en koodikuvaus_fi koodikuvaus_sv koodikuvaus_en koodistouri koodiuri
    koodiversio:int koodiversiocreated_at:time_ntz=luotu koodiversioupdated_at:time_ntz=muokattu tila
    voimassaalkupvm:date voimassaloppuvpm:date=voimassaloppupvm
    """,
    key=("koodi_id", ("koodistouri", "koodiarvo", "koodiversio")),
)
shape(
    "koodisto_relaatio",
    "alakoodiuri alakoodiversio:int relaatiotyyppi relaatioversio:int ylakoodiuri ylakoodiversio:int",
    key=(
        "koodirelaatio_id",
        ("alakoodiuri", "alakoodiversio", "relaatiotyyppi", "relaatioversio", "ylakoodiuri", "ylakoodiversio"),
    ),
    derive=lambda df, now: {"muokattu": F.col("dw_metadata_source_timestamp_at")},
)
shape(
    "onr_henkilo",
    """
    henkilo_oid master_oid etunimet sukunimi hetu kotikunta syntymaaika:date aidinkieli kansalaisuus sukupuoli:int
    turvakielto:bool yksiloityvtj:bool created:time=luotu updated:time=muokattu
    """,
    derive=lambda df, now: {"kansalaisuus": comma_list("kansalaisuus")},
    metadata=False,
)
shape(
    "onr_yhteystieto",
    "henkilo_oid yhteystieto_arvo_tyyppi alkupera yhteystieto_arvo yhteystietotyyppi",
    key=(
        "yhteystieto_id",
        ("henkilo_oid", "yhteystieto_arvo_tyyppi", "alkupera", "yhteystieto_arvo", "yhteystietotyyppi"),
    ),
)

ORGANISATION_TYPES = tuple(f"organisaatiotyyppi_0{n}" for n in (1, 2, 3, 4))

shape(
    "organisaatio_organisaatio",
    """
    organisaatio_oid alkupvm:time nimi_fi nimi_sv organisaatiotyypit paivityspvm:time=muokattu tila
    grandparent_oid=ylin_organisaatio kotipaikka=sijaintikunta opetuskielet parent_oid=ylempi_organisaatio
    oppilaitostyyppi oppilaitosnumero lakkautuspvm:time
    """,
    derive=lambda df, now: {
        "organisaatiotyypit": comma_list("organisaatiotyypit"),
        "opetuskielet": comma_list("opetuskielet"),
    },
    keep=lambda: F.arrays_overlap(
        jsonx.elements("organisaatiotyypit"), F.array(*[F.lit(t) for t in ORGANISATION_TYPES])
    ),
)
shape(
    "organisaatio_organisaatiosuhde",
    "suhdetyyppi parent_oid child_oid alkupvm:time",
    key=("suhde_id", ("suhdetyyppi", "parent_oid", "child_oid")),
)
shape(
    "organisaatio_osoite",
    "organisaatio_oid kieli osoitetyyppi osoite postinumero postitoimipaikka",
    key=("organisaatioosoite_id", ("organisaatio_oid", "kieli", "osoitetyyppi")),
)
shape("organisaatio_ryhma", "oid nimiFi=nimi_fi nimiSv=nimi_sv nimiEn=nimi_en")
