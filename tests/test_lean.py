"""What is shuffled and written is as narrow as the result needs."""

import pytest
from pyspark.sql import functions as F

from lakemart.functions.keys import surrogate_key
from lakemart.plans.catalog import MODELS, evaluate
from lakemart.queries import admission_documents as documents
from lakemart.queries import admissions
from lakemart.queries.registry import Source

FOLDER = "/root/testdata/sf0.001"
DIGESTS = {"hakutoive_id", "hakukohde_henkilo_id", "valinnantulos_id", "jonosija_id", "ilmoittautuminen_id", "hakemus_versio_id", "henkilo_hakemus_id"}


def shuffled(df) -> list[set[str]]:
    """Columns of every shuffle by key of a plan."""
    jvm = df.sparkSession._jvm
    text = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = []
    for node in text.split("\n\n"):
        if " Exchange" in node.split("\n")[0] and "hashpartitioning" in node:
            line = next(x for x in node.split("\n") if x.startswith("Input"))
            found.append({c.split("#")[0].strip() for c in line.split(": [")[1].rstrip("]").split(",")})
    return found


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def built(spark, *wanted):
    return evaluate(documents.reader(Source(spark, FOLDER)), list(wanted), F.lit(admissions.NOW).cast("timestamp"))


def test_whole_applications_are_shuffled_once_and_without_their_digest(spark):
    found = shuffled(built(spark, "int_ataru_hakemus")["int_ataru_hakemus"])
    assert len([c for c in found if "tiedot" in c]) == 1
    assert not any(c & DIGESTS for c in found)


def test_choices_are_shuffled_without_digests_and_only_twice(spark, no_broadcast):
    found = shuffled(built(spark, "int_hakutoive")["int_hakutoive"])
    assert not any(c & {"valinnantulos_id", "jonosija_id", "ilmoittautuminen_id", "hakemus_versio_id", "hakukohde_henkilo_id"} for c in found)
    assert len([c for c in found if "hakutoivenumero" in c]) == 2


def test_reports_shuffle_the_columns_that_digests_are_made_of(spark, no_broadcast):
    found = shuffled(built(spark, "pub_fct_raportti_tilastoraportti_kk")["pub_fct_raportti_tilastoraportti_kk"])
    assert not any(c & {"hakutoive_id", "hakukohde_henkilo_id", "henkilo_hakemus_id"} for c in found if "hakutoivenumero" in c)


def test_only_columns_that_are_taken_are_stored_and_a_later_mart_gets_all(spark):
    assert "valintatapajonot" not in admissions.taken("int_hakutoive", ["pub_fct_raportti_tilastoraportti_kk"])
    assert "tiedot" not in admissions.taken("int_ataru_hakemus", ["int_hakutoive"])
    assert admissions.taken("int_hakutoive", ["pub_dim_hakutoive"]) is None
    kept = dict(admissions.STORED)
    admissions.forget()
    try:
        admissions.marts(Source(spark, FOLDER), "int_hakutoive")
        (whole,) = admissions.marts(Source(spark, FOLDER), "int_ataru_hakemus")
        assert {"tiedot", "hakemus_versio_id", "kasittelymerkinnat"} <= {*whole.columns}
        admissions.marts(Source(spark, FOLDER), "pub_fct_raportti_hakijat_kk")
        (choices,) = admissions.marts(Source(spark, FOLDER), "int_hakutoive")
        expected = built(spark, "int_hakutoive")["int_hakutoive"]
        assert choices.columns == expected.columns
        assert choices.exceptAll(expected).count() == 0 and expected.exceptAll(choices).count() == 0
    finally:
        admissions.STORED.clear()
        admissions.STORED.update(kept)


def test_digests_of_null_parts_meet_as_before(spark, rows):
    """A choice without a target finds its selection, since NULL is part of a digest like any other value."""
    models = ["int_ataru_hakutoive", "int_ataru_hakemus", "int_haku", "int_valintarekisteri_hyvaksyttyjulkaistuhakutoive", "int_vastaanotto",
              "int_valinta", "int_harkinnanvaraisuus", "int_valintarekisteri_ilmoittautuminen", "int_ensikertalainen"]
    frames = {name: df.limit(0) for name, df in built(spark, *models).items()}
    choice = rows([("A1", "P1", None, 1, False)], "hakemus_oid string, henkilo_oid string, hakukohde_oid string, hakutoivenumero bigint, poistettu boolean").withColumns(
        {"hakutoive_id": surrogate_key("hakemus_oid", "hakukohde_oid"), "hakukohde_henkilo_id": surrogate_key("hakukohde_oid", "henkilo_oid")})
    add = lambda name, df: frames.__setitem__(name, frames[name].unionByName(df, allowMissingColumns=True))
    add("int_ataru_hakutoive", choice)
    add("int_valinta", choice.select("hakutoive_id", F.lit("VARALLA").alias("valintatieto")))
    add("int_vastaanotto", choice.select("hakukohde_henkilo_id", F.lit("PERUNUT").alias("vastaanottotieto")))
    (found,) = MODELS["int_hakutoive"].build(*[frames[n] for n in models]).collect()
    assert (found["valintatieto"], found["vastaanottotieto"], found["hakutoive_id"]) == ("VARALLA", "PERUNUT", choice.first()["hakutoive_id"])
