"""Admission documents derived from the shared test tables.

Orders become applications, their line items choices and selection results,
customers persons, parts study targets, suppliers organisations and queues,
nations and regions municipalities and provinces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.plans.catalog import raw_defaults
from lakemart.plans.int1 import DETAIL_IS_CODE
from lakemart.queries.registry import Source
from lakemart.session import work_path

TARGET = "1.2.246.562.20."
FORM = "00000000-0000-0000-0000-000000000001"
GROUP_SIZE = 100
EARLY, LATE = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
DOUBLE = "4fe08958-c0b7-4847-8826-e42503caa662"
ATHLETE = "ammatillinen_perustutkinto_urheilijana"


def text(prefix: str, column) -> Column:
    return F.concat(F.lit(prefix), (F.col(column) if isinstance(column, str) else column).cast("string"))


def iso(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def raw(df: DataFrame, document: Column, table: str, copied: str = EARLY, is_text: bool = False) -> DataFrame:
    """Documents with the load metadata of the landing."""
    when = F.lit(copied).cast("timestamp")
    return df.select(
        (document if is_text else F.to_json(document)).alias("data"),
        when.alias("dw_metadata_source_timestamp_at"),
        when.alias("dw_metadata_dbt_copied_at"),
        F.lit(f"{table}__{copied[:10]}_00.00.00Z__1.json").alias("dw_metadata_filename"),
        F.lit(1).alias("dw_metadata_file_row_number"),
    )


def obj(**fields) -> Column:
    """Struct of named columns; plain Python values become literals."""
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])


def results(t: Source) -> DataFrame:
    """One result per order and part, with the order's customer.  Several raw
    tables start from it, so it is written to the shared folder once."""
    if "selection_results" not in vars(t):
        path = work_path(t.spark, "selection_results")
        _results(t).write.parquet(path)
        t.selection_results = t.spark.read.parquet(path)
    return t.selection_results


def _results(t: Source) -> DataFrame:
    """Of the line items of an order with one part, the first is its result."""
    order = ["l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus"]
    first = F.min(F.struct(*order)).alias("l")
    per_part = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(first).select("l_orderkey", "l_partkey", "l.*")
    return per_part.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))


def choices_per_order(t: Source) -> DataFrame:
    """All choices of an order in the order of its line numbers, a target once."""
    item = F.struct("l_linenumber", "l_partkey")
    lists = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return lists.select("o_orderkey", F.array_distinct(F.transform("items", lambda x: text(TARGET, x["l_partkey"]))).alias("choices"))


def search_of(priority: str = "o_orderpriority") -> Column:
    return F.concat(F.lit("H"), F.left(priority, F.lit(1)))


def applications(t: Source, copied: str = LATE) -> DataFrame:
    """Current versions of all applications."""
    # spread by the join key first: writing the documents is the work here
    orders = t.orders.repartition("o_orderkey").join(choices_per_order(t), ["o_orderkey"], "left")
    first = F.get("choices", F.lit(0))
    reviews = F.when(
        first.isNotNull(),
        F.array(
            obj(
                requirement="eligibility-state", hakukohde=first,
                state=F.when(F.col("o_totalprice") > 100000, "eligible").otherwise("uneligible"),
            ),
            obj(
                requirement="payment-obligation", hakukohde=first,
                state=F.when(F.col("o_custkey") % 3 == 0, "obligated").otherwise("not-obligated"),
            ),
        ),
    )
    plain = F.map_from_arrays(
        F.array(F.lit("home-town"), F.lit("country-of-residence"), F.lit("gender"), F.lit("asiointikieli")),
        F.array(
            (F.col("o_custkey") % 25).cast("string"), F.lit("246"),
            F.when(F.col("o_custkey") % 2 == 0, "mies").otherwise("2"), F.lit("1"),
        ),
    )
    health = F.create_map(
        F.concat(F.lit("sora-terveys_"), first), F.when(F.col("o_custkey") % 2 == 0, "1").otherwise("0"),
        F.concat(F.lit("sora-aiempi_"), first), F.lit("1"),
        F.lit("sora-terveys"), F.lit("0"),
    )
    double = F.create_map(F.concat(F.lit(f"{DOUBLE}_"), first), F.when(F.col("o_custkey") % 2 == 0, "0").otherwise("1"))
    athlete = F.create_map(F.lit(ATHLETE), F.lit("0"), F.lit("1dc3311d-2235-40d6-88d2-de2bd63e087b"), F.lit("0"))
    triggers = F.create_map(F.lit(DOUBLE), F.lit("x"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    has_choice = first.isNotNull()
    texts = F.map_concat(
        plain,
        F.when(has_choice & (F.col("o_orderpriority") >= "3"), health).otherwise(none),
        F.when(has_choice & (F.col("o_orderstatus") == "O"), double).otherwise(none),
        F.when(F.col("o_orderstatus") == "O", triggers).otherwise(none),
        F.when(F.col("o_orderstatus") == "F", athlete).otherwise(none),
    )
    document = obj(
        hakemusOid=text("A", "o_orderkey"), id=F.lit(2), form_key=FORM, form=F.lit(1), created_time=iso(F.col("o_orderdate")),
        state=F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000), "inactivated").otherwise("active"),
        submitted=iso(F.col("o_orderdate")), lang="fi", application_hakukohde_reviews=reviews, hakuOid=search_of(),
        hakukohde=F.coalesce("choices", F.array().cast("array<string>")), person_oid=text("P", "o_custkey"),
        modified_time=iso(F.col("o_orderdate")),
    )
    # answers are texts under keys that differ per application, and two lists
    lists = F.lit('{"keyValues":{"higher-completed-base-education":["pohjakoulutus_yo"],"nationality":[["246"]],')
    whole = F.concat(lists, F.substr(F.to_json(texts), F.lit(2)), F.lit(","), F.substr(F.to_json(document), F.lit(2)))
    return raw(orders, whole, "ataru_hakemus", copied, is_text=True)


def first_versions(t: Source) -> DataFrame:
    """Earlier versions of finished orders' applications, with one other choice."""
    orders = t.orders.filter(F.col("o_orderstatus") == "F").repartition("o_orderkey")
    document = obj(
        hakemusOid=text("A", "o_orderkey"), id=F.lit(1), form_key=FORM, form=F.lit(1),
        keyValues=F.create_map(F.lit("home-town"), F.lit("0")), state="active", hakuOid=search_of(),
        hakukohde=F.array(F.lit(f"{TARGET}0")), person_oid=text("P", "o_custkey"),
        modified_time=iso(F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")),
    )
    return raw(orders, document, "ataru_hakemus")


def persons(t: Source) -> DataFrame:
    key = F.col("c_custkey")
    language = F.when(F.col("c_mktsegment") == "BUILDING", "fi").when(F.col("c_mktsegment") == "MACHINERY", "sv").otherwise("en")
    citizenship = F.when(F.col("c_nationkey") < 5, "246").when(F.col("c_nationkey") < 10, "840,246").when(
        F.col("c_nationkey") < 15, "840,752"
    ).otherwise("840")
    document = obj(
        henkilo_oid=text("P", key), master_oid=F.when(key % 7 == 3, text("P", key - 1)), etunimet=F.col("c_name"),
        sukunimi=F.col("c_mktsegment"), kotikunta=F.col("c_nationkey").cast("string"), aidinkieli=language,
        sukupuoli=(key % 2 + 1).cast("int"), turvakielto=F.lit(False), yksiloityvtj=F.lit(True), kansalaisuus=citizenship,
        created="2020-01-01T00:00:00Z", updated="2024-01-01T00:00:00Z",
    )
    return raw(t.customer, document, "onr_henkilo")


def searches(t: Source) -> DataFrame:
    """One search per order priority; the first two in higher education."""
    number = F.left("o_orderpriority", F.lit(1))
    document = obj(
        oid=search_of(), tila="julkaistu", nimi=obj(fi=F.col("o_orderpriority")), hakutapaKoodiUri="hakutapa_01#1",
        kohdejoukkoKoodiUri=F.when(number <= "2", "haunkohdejoukko_12#1").otherwise("haunkohdejoukko_11#1"),
        metadata=obj(koulutuksenAlkamiskausi=F.when(number == "1", obj(
            alkamiskausityyppi="alkamiskausi ja -vuosi", koulutuksenAlkamisvuosi="2024", koulutuksenAlkamiskausiKoodiUri="kausi_s#1"
        ))),
        hakuajat=F.array(obj(alkaa="2024-08-01T08:00", paattyy="2024-09-15T15:00"), obj(alkaa="2024-02-01T08:00", paattyy="2024-03-15T15:00")),
        modified="2024-01-01T00:00",
    )
    return raw(t.orders.select("o_orderpriority").distinct(), document, "kouta_haku")


def parameters(t: Source) -> DataFrame:
    document = obj(
        key=search_of(), lastModified="2024-01-01T00:00", values=obj(
            PH_OPVP=obj(date=F.lit(1720796400000)), PH_HPVOA=obj(value=F.lit(14)),
            jarjestetytHakutoiveet=(F.left("o_orderpriority", F.lit(1)) != "5"),
        ),
    )
    return raw(t.orders.select("o_orderpriority").distinct(), document, "ohjausparametrit_parameter")


def targets(t: Source) -> DataFrame:
    size = F.col("p_size")
    season = F.when(size % 2 == 1, obj(
        alkamiskausityyppi=F.lit("alkamiskausi ja -vuosi"), koulutuksenAlkamisvuosi=F.lit("2025"),
        koulutuksenAlkamiskausiKoodiUri=F.lit("kausi_k#1"), koulutuksenAlkamispaivamaara=F.lit(None).cast("string"),
    )).when(size % 10 == 0, obj(
        alkamiskausityyppi=F.lit("tarkka alkamisajankohta"), koulutuksenAlkamisvuosi=F.lit(None).cast("string"),
        koulutuksenAlkamiskausiKoodiUri=F.lit(None).cast("string"), koulutuksenAlkamispaivamaara=F.lit("2024-08-10T00:00"),
    ))
    document = obj(
        oid=text(TARGET, "p_partkey"), toteutusOid=text("T", size), hakuOid=text("H", size % 5 + 1), tila="julkaistu",
        jarjestyspaikkaOid=text("O", F.col("p_partkey") % 100), kaytetaanHaunAikataulua=(size % 3 == 0),
        pohjakoulutusvaatimusKoodiUrit=F.array(F.lit("pohjakoulutusvaatimuskouta_yo#1"), F.lit("pohjakoulutusvaatimuskouta_am#1")),
        metadata=obj(koulutuksenAlkamiskausi=season, aloituspaikat=obj(lukumaara=size)),
        enrichedData=obj(esitysnimi=obj(fi=F.col("p_name"))), modified="2024-01-01T00:00",
    )
    return raw(t.part, document, "kouta_hakukohde")


def offers(t: Source) -> DataFrame:
    document = obj(
        oid=text("T", "p_size"), koulutusOid=text("K", F.col("p_size") % 6), tila="julkaistu",
        metadata=obj(opetus=obj(opetuskieliKoodiUrit=F.array(F.lit("oppilaitoksenopetuskieli_2#1"), F.lit("oppilaitoksenopetuskieli_1#1")))),
        enrichedData=obj(esitysnimi=obj(fi=text("offer ", "p_size"))), modified="2024-01-01T00:00",
    )
    return raw(t.part.select("p_size").distinct(), document, "kouta_toteutus")


def education_code(kind: Column) -> Column:
    """Education codes by kind: 0-1 lower, 2-3 higher, 4 medicine, 5 doctoral degrees."""
    return F.when(kind < 2, text("61111", kind)).when(kind < 4, text("71111", kind)).when(kind == 4, "772101").otherwise("811111")


def educations(t: Source) -> DataFrame:
    kinds = t.part.select((F.col("p_size") % 6).alias("kind")).distinct()
    document = obj(
        oid=text("K", "kind"), tila="julkaistu",
        koulutuksetKoodiUri=F.array(F.concat(F.lit("koulutus_"), education_code(F.col("kind")), F.lit("#1"))),
        metadata=obj(opintojenLaajuusNumeroMin=F.lit(60.0), opintojenLaajuusNumeroMax=(F.col("kind") * 30 + 60).cast("double")),
        enrichedData=obj(esitysnimi=obj(fi=text("education ", "kind"))), modified="2024-01-01T00:00",
    )
    return raw(kinds, document, "kouta_koulutus")


def code_documents(df: DataFrame, code_set, value, name, state="LUONNOS") -> DataFrame:
    value, name = (c if isinstance(c, Column) else F.lit(c) for c in (value, name))
    uri = F.concat(F.lit(f"{code_set}_"), value)
    document = obj(
        koodistouri=code_set, koodiuri=uri, koodiarvo=value, koodiversio=F.lit(1), tila=state, koodinimi_fi=name,
        koodiversioupdated_at="2024-01-01T00:00:00",
    )
    return raw(df, document, "koodisto_koodi")


LEVEL_SETS = [
    *[f"kansallinenkoulutusluokitus2016koulutusastetaso{n}" for n in (1, 2)],
    *[f"kansallinenkoulutusluokitus2016koulutusalataso{n}" for n in (1, 2, 3)],
]


def codes(t: Source) -> DataFrame:
    """Municipalities and provinces from nations and regions, educations from
    parts, countries from customers."""
    kinds = t.part.select((F.col("p_size") % 6).alias("kind")).distinct()
    fields = kinds.select((F.col("kind") % 3).alias("field")).distinct()
    country = F.explode(F.array(F.lit("246"), F.lit("752"), F.lit("840"))).alias("country")
    countries = t.customer.select(country).distinct()
    frames = [
        code_documents(t.nation, "kunta", F.col("n_nationkey").cast("string"), F.col("n_name")),
        code_documents(t.region, "maakunta", F.col("r_regionkey").cast("string"), F.col("r_name")),
        code_documents(kinds, "koulutus", education_code(F.col("kind")), text("kind ", "kind")),
        code_documents(countries, "maatjavaltiot2", F.col("country"), text("country ", "country")),
        code_documents(t.region.filter("r_regionkey = 0"), "valtioryhmat", "EU", "EU"),
        *[code_documents(fields, s, F.col("field").cast("string"), text("field ", "field")) for s in LEVEL_SETS],
        *[
            code_documents(t.region.filter(f"r_regionkey = {n}"), "organisaatiotyyppi", f"0{n}", f"type {n}")
            for n in (1, 2, 3)
        ],
    ]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def relation_documents(df: DataFrame, upper: Column, lower: Column, version=1) -> DataFrame:
    document = obj(
        ylakoodiuri=upper, ylakoodiversio=F.lit(1), alakoodiuri=lower, alakoodiversio=F.lit(1), relaatiotyyppi="SISALTYY",
        relaatioversio=F.lit(version),
    )
    return raw(df, document, "koodisto_relaatio")


def relations(t: Source) -> DataFrame:
    kinds = t.part.select((F.col("p_size") % 6).alias("kind")).distinct()
    education = F.concat(F.lit("koulutus_"), education_code(F.col("kind")))
    frames = [
        relation_documents(t.nation, text("kunta_", "n_nationkey"), text("maakunta_", "n_regionkey")),
        relation_documents(t.region.filter("r_regionkey = 0"), F.lit("maatjavaltiot2_752"), F.lit("valtioryhmat_EU")),
        *[relation_documents(kinds, education, text(f"{s}_", F.col("kind") % 3)) for s in LEVEL_SETS],
    ]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def organisations(t: Source) -> DataFrame:
    """Suppliers as a tree by leading digits: provider, institutions, offices."""
    key = F.col("s_suppkey")
    kind = F.when(key == 0, "organisaatiotyyppi_01").when(key < 10, "organisaatiotyyppi_02").otherwise("organisaatiotyyppi_03")
    document = obj(
        organisaatio_oid=text("O", key), parent_oid=F.when(key > 0, text("O", F.floor(key / 10))), nimi_fi=F.col("s_name"),
        organisaatiotyypit=kind, paivityspvm="2024-01-01T00:00", tila="AKTIIVINEN", kotipaikka=text("kunta_", "s_nationkey"),
        opetuskielet="oppilaitoksenopetuskieli_1#1",
    )
    return raw(t.supplier, document, "organisaatio_organisaatio")


def result_time() -> Column:
    """Later orders change later, so the newest row of a person and target is definite."""
    return iso(F.timestamp_seconds(F.lit(1704067200) + F.col("l_orderkey")))


def person_target() -> dict:
    return {"hakukohdeOid": text(TARGET, "l_partkey"), "henkiloOid": text("P", "o_custkey")}


def selection_results(t: Source) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    state = (
        F.when(flag == "R", "HYVAKSYTTY").when((flag == "A") & (status == "F"), "VARASIJALTA_HYVAKSYTTY")
        .when(flag == "A", "VARALLA").when(status == "F", "PERUNUT").otherwise("HYLATTY")
    )
    document = obj(
        **person_target(), valintatapajonoOid=queue(), hakemusOid=text("A", "l_orderkey"), valinnantila=state,
        ehdollisestiHyvaksyttavissa=(F.col("l_suppkey") % 2 == 0), julkaistavissa=F.lit(True), muokattu=result_time(),
    )
    return raw(results(t), document, "valintarekisteri_valinnantulos")


def places_in_queues(t: Source) -> DataFrame:
    document = obj(
        hakemusOid=text("A", "l_orderkey"), hakukohdeOid=text(TARGET, "l_partkey"), valintatapajonoOid=queue(),
        hyvaksyttyHarkinnanvaraisesti=(F.col("l_suppkey") % 5 == 0), jonosija=F.col("l_linenumber"), pisteet=F.lit(10.5),
        sijoitteluajoId="1", systemTime="2024-01-01T00:00:00Z", prioriteetti=F.lit(1),
    )
    return raw(results(t), document, "valintarekisteri_jonosija")


def queue() -> Column:
    """A queue per target and supplier."""
    return F.concat(text("J", "l_partkey"), text("-", "l_suppkey"))


def queues(t: Source) -> DataFrame:
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    named = pairs.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    document = obj(
        oid=queue(), hakukohdeOid=text(TARGET, "l_partkey"), nimi=F.col("s_name"), prioriteetti=F.col("s_nationkey"),
    )
    return raw(named, document, "valintarekisteri_valintatapajono")


def acceptances(t: Source) -> DataFrame:
    third = F.col("l_suppkey") % 3
    action = F.when(third == 0, "VASTAANOTTANUT_SITOVASTI").when(third == 1, "PERUUTETTU").otherwise("EHDOLLISESTI_VASTAANOTTANUT")
    document = obj(**person_target(), action=action, timestamp=result_time())
    return raw(results(t).filter(F.col("l_returnflag") == "R"), document, "valintarekisteri_vastaanotto")


ENROLMENTS = ("LASNA_SYKSY", "POISSA", "LASNA_KOKO_LUKUVUOSI", "EI_TEHTY")


def enrolments(t: Source) -> DataFrame:
    state = F.get(F.array(*[F.lit(s) for s in ENROLMENTS]), (F.col("l_suppkey") % 4).cast("int"))
    document = obj(**person_target(), tila=state, timestamp=result_time())
    return raw(results(t).filter(F.col("l_returnflag") != "N"), document, "valintarekisteri_ilmoittautuminen")


def publications(t: Source) -> DataFrame:
    day = F.timestamp_seconds(F.lit(1719835200) + F.col("l_suppkey") * 3600)
    document = obj(**person_target(), hyvaksyttyJaJulkaistu=iso(day), systemTime=result_time())
    return raw(results(t).filter(F.col("l_returnflag") == "R"), document, "valintarekisteri_hyvaksyttyjulkaistuhakutoive")


def first_timers(t: Source) -> DataFrame:
    pairs = t.orders.select("o_orderpriority", "o_custkey").distinct()
    document = obj(
        hakuOid=search_of(), henkiloOid=text("P", "o_custkey"), isEnsikertalainen=(F.col("o_custkey") % 4 == 0)
    )
    return raw(pairs, document, "sure_ensikertalainen")


def groups(t: Source) -> DataFrame:
    """Groups of up to a hundred targets with neighbouring keys."""
    members = F.array_sort(F.collect_list(text(TARGET, "p_partkey"))).alias("members")
    numbered = t.part.groupBy(F.floor(F.col("p_partkey") / GROUP_SIZE).alias("nr")).agg(members)
    document = F.struct(
        text("R", "nr").alias("hakukohderyhma-oid"), F.col("members").alias("hakukohde-oids"),
        F.lit("2024-01-01T00:00").alias("last-modified"),
    )
    return raw(numbered, document, "hakukohderyhmapalvelu_ryhma")


def group_names(t: Source) -> DataFrame:
    numbers = t.part.select(F.floor(F.col("p_partkey") / GROUP_SIZE).alias("nr")).distinct()
    return raw(numbers, obj(oid=text("R", "nr"), nimiFi=text("group ", "nr")), "organisaatio_ryhma")


def forms(t: Source) -> DataFrame:
    """One form; its special questions concern the first two groups."""
    def question(name: str, group: str) -> Column:
        return F.struct(F.lit(name).alias("id"), F.array(F.lit(group)).alias("belongs-to-hakukohderyhma"))

    content = F.array(question(DOUBLE, "R0"), question(ATHLETE, "R1"))
    document = F.struct(
        F.lit(FORM).alias("key"), F.lit(1).alias("id"), F.lit("2024-01-01T00:00").alias("created-time"), content.alias("flat-content")
    )
    return raw(t.region.filter("r_regionkey = 0"), document, "ataru_lomake")


def millis(value: Column) -> Column:
    return F.unix_millis(value.cast("timestamp"))


def achievements(t: Source) -> DataFrame:
    """One examination per order; finished ones have an earlier, open version."""
    def version(orders: DataFrame, state, changed: Column) -> DataFrame:
        document = obj(
            resourceId=text("S", "o_orderkey"), komo="yotutkinto", myontaja=text("O", F.col("o_custkey") % 100), tila=state,
            valmistuminen=F.date_format("o_orderdate", "yyyy-MM-dd"), henkiloOid=text("P", "o_custkey"), suoritusKieli="FI",
            inserted=millis(changed), deleted=F.col("o_orderpriority").startswith("5"), source="register", vahvistettu=F.lit(True),
        )
        return raw(orders, document, "sure_suoritus")

    day = F.col("o_orderdate").cast("timestamp")
    current = version(t.orders, F.when(F.col("o_orderstatus") == "F", "VALMIS").otherwise("KESKEN"), day + F.expr("INTERVAL 2 DAY"))
    return current.unionByName(version(t.orders.filter("o_orderstatus = 'F'"), "KESKEN", day))


GRADES = ("I", "A", "B", "C", "M", "E", "L")


def grades(t: Source) -> DataFrame:
    """A grade per order and part; the subject is the part's number of ten."""
    rows = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(
        F.min(F.struct("l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")).alias("l")
    ).select("l_orderkey", "l_partkey", "l.*")
    document = obj(
        resourceId=F.concat(text("G", "l_orderkey"), text("-", "l_partkey")), suoritus=text("S", "l_orderkey"),
        arvosana=F.get(F.array(*[F.lit(g) for g in GRADES]), (F.col("l_suppkey") % 7).cast("int")),
        asteikko=F.when(F.col("l_returnflag") == "N", "4-10").otherwise("YO"),
        aine=F.when(F.col("l_suppkey") % 4 == 0, "unknown exam").otherwise(DETAIL_IS_CODE), lisatieto=text("K", F.col("l_partkey") % 10),
        valinnainen=F.lit(False), inserted=F.lit(1704067200000) + F.col("l_linenumber") * 1000, deleted=F.col("l_linestatus") == "F", source="register",
    )
    return raw(rows, document, "sure_arvosana")


def study_rights(t: Source) -> DataFrame:
    document = obj(
        resourceId=text("E", "c_custkey"), alkuPaiva=F.lit(1704067200000), henkiloOid=text("P", "c_custkey"), komo=F.col("c_mktsegment"),
        myontaja=text("O", F.col("c_custkey") % 10), source="register", inserted=F.lit(1704067200000), deleted=F.col("c_acctbal") < 0,
    )
    return raw(t.customer, document, "sure_opiskeluoikeus")


# raw table -> function that derives it
SOURCES = {
    "ataru_hakemus": lambda t: first_versions(t).unionByName(applications(t)),
    "ataru_lomake": forms,
    "hakukohderyhmapalvelu_ryhma": groups,
    "organisaatio_ryhma": group_names,
    "onr_henkilo": persons,
    "kouta_haku": searches,
    "ohjausparametrit_parameter": parameters,
    "kouta_hakukohde": targets,
    "kouta_toteutus": offers,
    "kouta_koulutus": educations,
    "koodisto_koodi": codes,
    "koodisto_relaatio": relations,
    "organisaatio_organisaatio": organisations,
    "valintarekisteri_valinnantulos": selection_results,
    "valintarekisteri_jonosija": places_in_queues,
    "valintarekisteri_valintatapajono": queues,
    "valintarekisteri_vastaanotto": acceptances,
    "valintarekisteri_ilmoittautuminen": enrolments,
    "valintarekisteri_hyvaksyttyjulkaistuhakutoive": publications,
    "sure_ensikertalainen": first_timers,
    "sure_suoritus": achievements,
    "sure_arvosana": grades,
    "sure_opiskeluoikeus": study_rights,
}


def reader(t: Source):
    """Raw tables by name; those without a derivation are empty."""
    return lambda name: SOURCES[name](t) if name in SOURCES else raw_defaults(t.spark, name)
