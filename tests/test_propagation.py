"""Changed rows are pushed along the models and give what a full rebuild gives."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.plans import model as M
from lakemart.plans.catalog import MODELS, evaluate
from lakemart.plans.derivations import DERIVATIONS
from lakemart.plans.propagation import difference, fingerprint, way
from lakemart.queries import admission_documents
from lakemart.queries.registry import Source
from lakemart.session import stored
from lakemart.sinks.versions import Tables
from tests.oracle import BASE

AT = datetime(2024, 6, 1)
MARTS = [
    "int_hakutoive_valintatapajono", "int_valinta", "int_vastaanotto", "int_valintarekisteri", "int_harkinnanvaraisuus", "int_hakutoive",
    "gen_hakutoive", "pub_dim_hakutoive", "int_maksuvelvollisuus", "pub_dim_maksuvelvollisuus", "pub_dim_henkilo",
    "pub_fct_raportti_tilastoraportti_kk",
]
GIVEN = sorted({t for n in MARTS for t in MODELS[n].tables} - set(MARTS) - {"int_sure_haut"})


class Loaded:
    """The marts stored over given tables, which a test may change."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.tables = Tables(spark, folder, bucket_bytes=10_000)
        self.models = {n: MODELS[n] for n in MARTS}
        self.seed = spark.createDataFrame([], "haku_oid string")
        derive = admission_documents.reader(Source(spark, f"{BASE}/sf0.001"))
        keep = lambda name, df: stored(df, name) if name in GIVEN else df
        for name, df in evaluate(derive, GIVEN, F.lit("2024-06-01").cast("timestamp"), store=keep).items():
            if name in GIVEN:
                self.tables.write(name, df)
        self.run()

    def read(self, name):
        return self.seed if name == "int_sure_haut" else self.tables.read(name)

    def run(self):
        M.run(self.tables, self.read, AT, MARTS, False, self.models)

    def change(self, name, fn):
        """Change a given table and keep what changed."""
        self.tables.write(name, fn(self.tables.read(name)), compare=difference)

    def versions(self):
        return {n: self.tables.version(n) for n in MARTS}

    def parts(self):
        return {n: {h.part: h.path for h in self.tables.live(n).held} for n in MARTS}

    def check(self):
        """Every stored mart equals its full rebuild."""
        keep = lambda name, df: stored(df, name)
        whole = evaluate(self.read, MARTS, F.lit(AT).cast("timestamp"), self.models, keep)
        for name in MARTS:
            assert difference(self.tables.read(name), whole[name]).count() == 0, name


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    return Loaded(spark, str(tmp_path_factory.mktemp("propagation")))


def test_one_changed_application_rewrites_one_bucket_of_each_mart(loaded):
    many = {n for n, parts in loaded.parts().items() if len(parts) >= 4}
    assert {"int_hakutoive", "pub_dim_hakutoive", "pub_dim_henkilo", "gen_hakutoive"} <= many
    loaded.tables.bucket_bytes = 1 << 20
    before, versions = loaded.parts(), loaded.versions()
    oid = loaded.tables.read("int_ataru_hakutoive").filter("NOT poistettu").groupBy("hakemus_oid").count().filter("count > 2").agg(F.min("hakemus_oid")).first()[0]
    mine = F.col("hakemus_oid") == oid
    loaded.change("int_ataru_hakutoive", lambda df: df.withColumn("poistettu", F.col("poistettu") | (mine & (F.col("hakutoivenumero") == 1))))
    loaded.change("int_ataru_hakemus", lambda df: df.withColumn("lahiosoite", F.when(mine, "elsewhere").otherwise(F.col("lahiosoite"))))
    loaded.run()
    loaded.check()
    after = loaded.parts()
    rewritten = {n: {p for p in before[n] | after[n] if before[n].get(p) != after[n].get(p)} for n in MARTS}
    for name in MARTS:
        if DERIVATIONS[name].unit == "hakemus_oid":
            assert len(rewritten[name]) <= 1, name
    assert len(rewritten["int_hakutoive"]) == len(rewritten["pub_dim_hakutoive"]) == len(rewritten["pub_dim_henkilo"]) == 1
    # what does not show the change is not written at all
    same = {n for n, v in loaded.versions().items() if v == versions[n]}
    assert {"int_valinta", "int_vastaanotto", "int_maksuvelvollisuus", "pub_dim_maksuvelvollisuus"} <= same


def test_a_run_without_changes_writes_nothing(loaded):
    loaded.run()
    lists = {n: loaded.tables._lists(n) for n in MARTS}
    loaded.run()
    assert {n: loaded.tables._lists(n) for n in MARTS} == lists


def test_changes_of_lookups_reach_what_shows_them(loaded):
    versions = loaded.versions()
    place = loaded.tables.read("int_valintarekisteri_vastaanotto").agg(F.min("hakukohde_henkilo_id")).first()[0]
    loaded.change("int_valintarekisteri_vastaanotto", lambda df: df.filter(F.col("hakukohde_henkilo_id") != place))
    # a master gets another name, and a person another master
    masters = loaded.tables.read("int_onr_henkilo").filter("master_oid <> henkilo_oid").agg(F.min("master_oid"), F.min("henkilo_oid")).first()
    other = loaded.tables.read("int_onr_henkilo").filter(F.col("henkilo_oid") != masters[0]).agg(F.max("henkilo_oid")).first()[0]
    loaded.change("int_onr_henkilo", lambda df: df.withColumns({
        "sukunimi": F.when(F.col("henkilo_oid") == masters[0], "Changed").otherwise(F.col("sukunimi")),
        "master_oid": F.when(F.col("henkilo_oid") == masters[1], other).otherwise(F.col("master_oid")),
    }))
    loaded.run()
    loaded.check()
    moved = {n for n, v in loaded.versions().items() if v != versions[n]}
    assert {"int_vastaanotto", "int_valintarekisteri", "int_hakutoive", "pub_dim_hakutoive", "pub_dim_henkilo"} <= moved
    assert not {"int_valinta", "int_maksuvelvollisuus"} & moved
    assert loaded.tables.read("pub_dim_henkilo").filter("sukunimi = 'Changed'").count() > 0


def test_inputs_without_a_way_derive_the_whole_model(loaded):
    search = loaded.tables.read("int_haku").agg(F.min("haku_oid")).first()[0]
    loaded.seed = loaded.spark.createDataFrame([(search,)], "haku_oid string")
    loaded.change("int_koodisto_kunta", lambda df: df.withColumn("koodinimi", F.lit('{"fi":"x","sv":"x","en":"x"}')))
    loaded.change("int_haku", lambda df: df.withColumn("jarjestetyt_hakutoiveet", F.when(F.col("haku_oid") == search, F.lit(False)).otherwise(F.col("jarjestetyt_hakutoiveet"))))
    queue = loaded.tables.read("int_valintarekisteri_valintatapajono").agg(F.min("valintatapajono_oid")).first()[0]
    loaded.change("int_valintarekisteri_valintatapajono", lambda df: df.withColumn("valintatapajono_nimi", F.when(F.col("valintatapajono_oid") == queue, "renamed").otherwise(F.col("valintatapajono_nimi"))))
    loaded.run()
    loaded.check()
    assert loaded.tables.read("gen_hakutoive").filter("jarjestelma = 'supa'").count() > 0


def test_lost_changes_derive_the_whole_model(loaded):
    """Changes that are not kept any more are no reason to miss them."""
    tables = loaded.tables
    oid = tables.read("int_ataru_hakemus").agg(F.max("hakemus_oid")).first()[0]
    for n in range(6):
        loaded.change("int_ataru_hakemus", lambda df: df.withColumn("puhelin", F.when(F.col("hakemus_oid") == oid, F.lit(str(n))).otherwise(F.col("puhelin"))))
        tables.prune("int_ataru_hakemus")
    known = tables.notes("pub_dim_henkilo")["from"]["int_ataru_hakemus"]
    assert tables.changes_since("int_ataru_hakemus", known) is None
    M.run(tables, loaded.read, AT, ["pub_dim_henkilo"], False, {"pub_dim_henkilo": MODELS["pub_dim_henkilo"]})
    assert tables.read("pub_dim_henkilo").filter("puhelin = '5'").count() == 1


def test_difference_counts_rows(rows):
    old = rows([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    new = rows([(1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    assert sorted(map(tuple, difference(old, new).collect()), key=repr) == [(1, "a"), (2, None), (3, "c")]


def test_ways_lead_there_and_back(rows):
    tables = {"middle": rows([("s1", "a1"), ("s1", "a2"), ("s2", "a3")], "search string, application string")}
    w = way("haku", "middle search application")
    changed = rows([("s1",), (None,)], "haku string")
    units = w.units(changed, tables.get)
    assert sorted(r[0] for r in units.collect()) == ["a1", "a2"]
    searches = rows([("s1", 1), ("s2", 2), ("s3", 3)], "haku string, n int")
    assert [r["n"] for r in w.rows(searches, rows([("a2",)], "_value string"), tables.get).collect()] == [1]


def test_fingerprint_sees_content_only(rows):
    a = rows([(1, "x"), (2, None)], "k int, v string")
    assert fingerprint(a) == fingerprint(a.orderBy(F.desc("k"))) != fingerprint(rows([(1, "x"), (2, "y")], "k int, v string"))
    assert fingerprint(a.limit(0)) == fingerprint(a.filter("k > 5"))
