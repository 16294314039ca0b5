"""Organisations: types, names, addresses, the tree, and its published forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx, text
from lakemart.operators import hierarchy, joins
from lakemart.plans.dw import current
from lakemart.plans.model import add, model

PROVIDER, INSTITUTION, OFFICE = "01", "02", "03"


@model()
def int_organisaatio_organisaatiotyyppi(
    dw_organisaatio_organisaatio: DataFrame, int_koodisto_organisaatiotyyppi: DataFrame
) -> DataFrame:
    """Type codes of each organisation as a JSON array."""
    types = current(dw_organisaatio_organisaatio, "organisaatio_oid").select(
        "organisaatio_oid", F.posexplode(jsonx.elements("organisaatiotyypit")).alias("place", "koodiuri")
    )
    known = int_koodisto_organisaatiotyyppi.filter("viimeisin_versio").select("koodiuri", "koodiarvo")
    listed = types.join(known, ["koodiuri"]).groupBy("organisaatio_oid").agg(
        F.array_sort(F.collect_list(F.struct("place", "koodiarvo"))).alias("t")
    )
    return listed.select("organisaatio_oid", F.to_json(F.col("t.koodiarvo")).alias("organisaatiotyypit"))


@model()
def int_organisaatio(
    int_organisaatio_organisaatio: DataFrame,
    int_organisaatio_organisaatiotyyppi: DataFrame,
    int_koodisto_kunta: DataFrame,
    int_koodisto_maakunta: DataFrame,
    int_koodisto_kunta_maakunta: DataFrame,
) -> DataFrame:
    """Organisations with names and places; a part of an office is named
    'office, part'."""
    rows = current(int_organisaatio_organisaatio, "organisaatio_oid")
    fi, sv = F.coalesce("nimi_fi", "nimi_sv"), F.coalesce("nimi_sv", "nimi_fi")
    offices = rows.filter(jsonx.has_element("organisaatiotyypit", "organisaatiotyyppi_03")).select(
        F.col("organisaatio_oid").alias("ylempi_organisaatio"), fi.alias("office_fi"), sv.alias("office_sv")
    )
    places = int_koodisto_kunta.filter("viimeisin_versio").select(
        F.col("koodiuri").alias("sijaintikunta"), F.col("koodinimi").alias("sijaintikunta_nimi")
    )
    regions = int_koodisto_maakunta.filter("viimeisin_versio").select(
        F.col("koodiuri").alias("sijaintimaakunta"), F.col("koodinimi").alias("sijaintimaakunta_nimi")
    )
    region_of = int_koodisto_kunta_maakunta.filter("viimeisin_versio").select(
        F.col("kunta_koodiuri").alias("sijaintikunta"), F.col("maakunta_koodiuri").alias("sijaintimaakunta")
    ).join(regions, ["sijaintimaakunta"])

    def full_name(office: Column, own: Column) -> Column:
        return F.when(F.col("office_fi").isNotNull(), F.concat(office, F.lit(", "), own)).otherwise(own)

    finnish, swedish = full_name(F.col("office_fi"), fi), full_name(F.col("office_sv"), sv)
    return (
        rows.drop("organisaatiotyypit")
        .join(offices, ["ylempi_organisaatio"], "left")
        .join(places, ["sijaintikunta"], "left")
        .join(int_organisaatio_organisaatiotyyppi, ["organisaatio_oid"], "left")
        .join(region_of, ["sijaintikunta"], "left")
        .select(
            "organisaatio_oid", jsonx.build(en=finnish, sv=swedish, fi=finnish).alias("organisaatio_nimi"),
            "ylempi_organisaatio", "sijaintikunta", "sijaintikunta_nimi", "sijaintimaakunta", "sijaintimaakunta_nimi",
            "opetuskielet", "organisaatiotyypit", "tila", "oppilaitostyyppi", "oppilaitosnumero", "alkupvm",
            "lakkautuspvm",
        )
    )


@model()
def int_organisaatio_osoite(
    dw_organisaatio_osoite: DataFrame, int_koodisto_posti: DataFrame, int_koodisto_kieli: DataFrame, int_organisaatio: DataFrame
) -> DataFrame:
    post = int_koodisto_posti.filter("viimeisin_versio").select(
        F.col("koodiuri").alias("postinumero"), F.col("koodiarvo").alias("_post"), "nimi_fi", "nimi_sv"
    )
    language = int_koodisto_kieli.filter("viimeisin_versio").select(
        F.col("versioitu_koodiuri").alias("kieli"), F.col("koodiarvo").alias("_language")
    )
    rows = dw_organisaatio_osoite.drop("postitoimipaikka").join(post, ["postinumero"]).join(language, ["kieli"])
    return joins.keep_matching(rows, int_organisaatio, ["organisaatio_oid"]).select(
        "organisaatio_oid", "osoitetyyppi", F.col("_language").alias("kieli"), "osoite", F.col("_post").alias("postinumero"),
        F.when(F.col("_language") == "SV", F.col("nimi_sv")).otherwise(F.col("nimi_fi")).alias("postitoimipaikka"),
        F.col("dw_metadata_dbt_copied_at").alias("ladattu"),
    )


@model()
def int_organisaatio_hakukohteiden_nimet(int_organisaatio: DataFrame) -> DataFrame:
    """For each place of study its office, institution and provider, searched
    for from the place upwards, and a name made of up to three levels."""
    nodes = int_organisaatio.select(
        "organisaatio_oid", "ylempi_organisaatio", "organisaatio_nimi",
        jsonx.elements("organisaatiotyypit").alias("types"), jsonx.translated("organisaatio_nimi").alias("n"),
    )
    levels = hierarchy.ancestors_by_level(
        nodes, "organisaatio_oid", "ylempi_organisaatio", ["organisaatio_nimi", "types", "n"], 3
    )

    def at(column: str, level: int) -> Column:
        return F.col(column if level == 0 else f"{column}_{level}")

    def is_type(kind: str, level: int) -> Column:
        return F.coalesce(F.array_contains(at("types", level), kind), F.lit(False))

    def nearest(kind: str, column: str) -> Column:
        return F.coalesce(*[F.when(is_type(kind, level), at(column, level)) for level in range(4)])

    upper = F.when(~is_type(PROVIDER, 1), at("n", 1))
    top = F.when(is_type(INSTITUTION, 2), at("n", 2))

    def label(lang: str) -> Column:
        own = F.coalesce(at("n", 0)[lang], F.lit(""))
        two = text.join_present(upper[lang], F.lit(", "), own)
        three = text.join_present(top[lang], F.lit(", "), two)
        return F.when(upper.isNull(), at("n", 0)[lang]).when(top.isNull(), two).otherwise(three)

    def own_if(kind: str, column: str) -> Column:
        return F.when(is_type(kind, 0), at(column, 0))

    oid, name = "organisaatio_oid", "organisaatio_nimi"
    return levels.select(
        F.col(oid).alias("jarjestyspaikka_oid"),
        jsonx.build(fi=label("fi"), sv=label("sv"), en=label("en")).alias("organisaatio_nimi"),
        own_if(OFFICE, oid).alias("toimipiste"),
        own_if(OFFICE, name).alias("toimipiste_nimi"),
        nearest(INSTITUTION, oid).alias("oppilaitos"),
        nearest(INSTITUTION, name).alias("oppilaitos_nimi"),
        nearest(PROVIDER, oid).alias("koulutustoimija"),
        nearest(PROVIDER, name).alias("koulutustoimija_nimi"),
    )


@model()
def int_organisaatio_rakenne(int_organisaatio: DataFrame) -> DataFrame:
    """All (ancestor, descendant) pairs, each organisation with itself, and
    every member of a tree under the empty parent of its root."""
    pairs = hierarchy.closure_with_self(int_organisaatio, "organisaatio_oid", "ylempi_organisaatio")
    roots = int_organisaatio.filter("ylempi_organisaatio IS NULL").select(F.col("organisaatio_oid").alias("ancestor"))
    under_nothing = joins.keep_matching(pairs, roots, ["ancestor"]).select(
        F.lit(None).cast("string").alias("parent_oid"), F.col("descendant").alias("child_oid")
    )
    named = pairs.select(F.col("ancestor").alias("parent_oid"), F.col("descendant").alias("child_oid"))
    return named.unionByName(under_nothing).distinct()


@model()
def pub_dim_organisaatio(int_organisaatio: DataFrame) -> DataFrame:
    return int_organisaatio.drop("ylempi_organisaatio")


@model()
def pub_dim_organisaatio_rakenne(int_organisaatio_rakenne: DataFrame) -> DataFrame:
    return int_organisaatio_rakenne.orderBy(F.col("parent_oid").asc_nulls_last(), "child_oid")


SHOWN = ["organisaatio_oid", "organisaatio_nimi", "organisaatiotyypit", "oppilaitostyyppi", "tila"]


def _of_type(kind: str):
    def build(organisations: DataFrame, tree: DataFrame) -> DataFrame:
        """Organisations of one type with their ancestors as a JSON array."""
        chosen = organisations.filter(jsonx.has_element("organisaatiotyypit", kind)).select(*SHOWN)
        above = tree.select(F.col("child_oid").alias("organisaatio_oid"), F.struct("parent_oid").alias("p"))
        lists = joins.keep_matching(above, chosen, ["organisaatio_oid"]).groupBy("organisaatio_oid").agg(
            F.array_sort(F.collect_list("p")).alias("parents")
        )
        quoted = F.transform("parents", lambda p: F.concat(F.lit('"'), p["parent_oid"], F.lit('"')))
        return chosen.join(lists, ["organisaatio_oid"], "left").select(
            *SHOWN, F.coalesce(jsonx.array_of(quoted), F.lit("[null]")).alias("parent_oids")
        )

    return build


def row_document() -> Column:
    """A published organisation as a JSON object."""
    plain = {c: F.col(c) for c in ("organisaatio_oid", "oppilaitostyyppi", "tila")}
    nested = {c: F.parse_json(c) for c in ("organisaatio_nimi", "organisaatiotyypit", "parent_oids", "children")}
    fields = {**plain, **nested}
    names = [*SHOWN, "parent_oids", "children"]
    return F.to_json(F.struct(*[fields[n].alias(n) for n in names]), {"ignoreNullFields": "false"})


def _with_children(same_table: bool = False):
    def build(parents: DataFrame, members: DataFrame) -> DataFrame:
        """Organisations with the members that name them as an ancestor."""
        if same_table:
            members = members.withColumn("children", F.lit("[]"))
        documents = members.select(
            F.col("organisaatio_oid").alias("_member"),
            F.explode(F.array_distinct(jsonx.elements("parent_oids"))).alias("organisaatio_oid"),
            row_document().alias("document"),
        ).filter(F.col("_member") != F.col("organisaatio_oid") if same_table else F.lit(True))
        lists = joins.keep_matching(documents, parents, ["organisaatio_oid"]).groupBy("organisaatio_oid").agg(
            jsonx.array_of(F.array_sort(F.collect_set("document"))).alias("children")
        )
        return parents.join(lists, ["organisaatio_oid"], "left").withColumn(
            "children", F.coalesce("children", F.lit("[]"))
        )

    return build


for _name, _kind in (("toimipiste", OFFICE), ("oppilaitos", INSTITUTION), ("koulutustoimija", PROVIDER)):
    add(f"pub_dim_{_name}", _of_type(_kind), ("pub_dim_organisaatio", "pub_dim_organisaatio_rakenne"))
add("pub_dim_toimipiste_ja_toimipisteet", _with_children(True), ("pub_dim_toimipiste", "pub_dim_toimipiste"))
add(
    "pub_dim_oppilaitos_ja_toimipisteet", _with_children(),
    ("pub_dim_oppilaitos", "pub_dim_toimipiste_ja_toimipisteet"),
)
add(
    "pub_dim_koulutustoimija_ja_toimipisteet", _with_children(),
    ("pub_dim_koulutustoimija", "pub_dim_oppilaitos_ja_toimipisteet"),
)
