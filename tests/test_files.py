import csv
import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.sinks.chunks import write_chunks
from lakemart.sinks.export import export_csv, export_layers, parts_of, read_export
from lakemart.sinks.versions import ProtectedHistory, Tables
from lakemart.sources import landing
from lakemart.sources.shred import Shape, fields, shred
from lakemart.streaming.arrivals import land_arrivals



def now():
    return F.lit("2024-06-01").cast("timestamp")


def put(folder, name, text):
    path = folder / "kouta" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_files_to_rows(spark, tmp_path):
    put(tmp_path, "kouta_haku__2024-05-01_10.30.00Z__a_1.json", '[{"oid":"1","n":null},{"oid":"2"}]')
    put(tmp_path, "kouta_haku__2024-05-02_10.30.00+03__b_1.json", "[]")
    put(tmp_path, "kouta_haku__2024-05-03_10.30.00Z__c_1.json", "")
    got = landing.land_files(spark, str(tmp_path), now()).orderBy("dw_metadata_file_row_number").collect()
    assert [(r.dw_metadata_file_row_number, json.loads(r.data)["oid"]) for r in got] == [(1, "1"), (2, "2")]
    assert got[0].dw_metadata_source_timestamp_at == datetime(2024, 5, 1, 10, 30)
    assert (got[0].source, got[0].raw_table) == ("kouta", "kouta_haku")
    assert got[0].dw_metadata_filename == "kouta_haku__2024-05-01_10.30.00Z__a_1.json"


def test_chunks_are_bounded_arrays_and_both_readers_agree(spark, tmp_path):
    docs = spark.range(0, 1001, numPartitions=3).select(F.to_json(F.struct("id", F.lit("[x],").alias("t"))).alias("doc"))
    path = f"{tmp_path}/kouta/numbers__2024-05-01_10.30.00Z__1"
    write_chunks(docs, "doc", 100, path)
    files = [f for f in (tmp_path / "kouta" / "numbers__2024-05-01_10.30.00Z__1").iterdir() if f.suffix == ".txt"]
    sizes = [len(json.loads(f.read_text())) for f in files]
    assert sum(sizes) == 1001 and max(sizes) <= 100
    keys = ["dw_metadata_filename", "dw_metadata_file_row_number", "data"]
    whole = landing.land_files(spark, str(tmp_path), now()).select(*keys)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = landing.land_element_lines(spark, str(tmp_path), now()).select(*keys)
        assert sorted(whole.collect()) == sorted(lines.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_reader_refuses_other_layouts(spark, tmp_path):
    put(tmp_path, "t__2024-05-01_10.30.00Z__1.json", '[{"a":\n1}]')
    with pytest.raises(Exception, match="not a list of whole objects"):
        landing.land_element_lines(spark, str(tmp_path), now()).collect()


def test_stream_lands_each_file_once(spark, tmp_path):
    source, raw, state = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "state")

    def count():
        land_arrivals(spark, str(source), raw, state, now())
        return spark.read.parquet(raw).count()

    put(source, "a__2024-05-01_10.30.00Z__1.json", '[{"n":1},{"n":2}]')
    assert count() == 2
    assert count() == 2
    put(source, "a__2024-05-02_10.30.00Z__1.json", '[{"n":3}]')
    put(source, "a__2024-05-03_10.30.00Z__1.json", "[]")
    assert count() == 3


def test_shred_casts_and_defaults(spark):
    document = {"oid": "x", "nimi": {"fi": "f"}, "values": {"n": 5, "deep": {"b": True}}, "lista": [1, "a"], "tyhja": None}
    raw = spark.createDataFrame(
        [(json.dumps(document), datetime(2024, 1, 1), datetime(2024, 1, 2), "f", 1), ("{}", None, None, "f", 2)], landing.ENVELOPE
    )
    shape = Shape("t", fields("oid nimi/* values:json values/n:int values/deep/b:bool lista:json tyhja puuttuu"), key=("id", ("oid",)))
    first, second = shred(raw, shape, now()).orderBy("dw_metadata_file_row_number").collect()
    assert (first.oid, first.nimi_fi, first.nimi_sv, first.n, first.b) == ("x", "f", None, 5, True)
    assert json.loads(first.lista) == [1, "a"] and json.loads(first["values"])["n"] == 5
    assert first.tyhja is None and first.puuttuu is None and second.oid is None
    assert first.id != second.id


def test_shred_raises_on_a_bad_number(spark):
    raw = spark.createDataFrame([('{"n":"abc"}', None, None, "f", 1)], landing.ENVELOPE)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shred(raw, Shape("t", fields("n:int")), now()).collect()


def test_reader_keeps_its_version_and_never_sees_half_a_write(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), prefix="dev_")
    assert not tables.exists("t")
    with pytest.raises(LookupError):
        tables.read("t")
    old = tables.write("t", spark.range(3))
    tables.write("t", tables.read("t").union(spark.range(2)))
    assert (old.count(), tables.read("t").count(), tables.version("t")) == (3, 5, 2)
    (tmp_path / "dev_t" / "v=000000003").mkdir()
    assert tables.version("t") == 2
    assert tables.write("t", spark.range(1)).count() == 1 and tables.version("t") == 4
    assert tables.names() == ["t"]


def test_history_is_not_rebuilt(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.rebuild("dw_t", spark.range(1), history=True)
    with pytest.raises(ProtectedHistory):
        tables.rebuild("dw_t", spark.range(1), history=True)


def test_export_layers(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables"))
    tables.write("pub_b", spark.createDataFrame([(1, 'say "x", y')], "k int, v string"))
    tables.write("pub_a", spark.range(2))
    tables.write("int_c", spark.range(2))
    manifests = export_layers(tables, ["pub_", "int_"], str(tmp_path / "out"))
    assert [t["key"].rsplit("/", 1)[0] for t in manifests["pub_"]["tables"]] == ["pub/pub_a.csv.gz", "pub/pub_b.csv.gz"]
    stored = json.loads((tmp_path / "out" / "pub" / "manifest.json").read_text())
    assert stored == manifests["pub_"]
    entry = stored["tables"][1]
    back = read_export(spark, f"{tmp_path}/out/{entry['key']}", entry["parts"], tables.read("pub_b").schema)
    assert [tuple(r) for r in back.collect()] == [(1, 'say "x", y')]
    again = export_layers(tables, ["pub_"], str(tmp_path / "out"))["pub_"]["tables"][1]
    assert again["key"] != entry["key"] and back.count() == 1


def test_parts_of_an_export_are_one_file(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else f'row, "{i}"') for i in range(500)]
    df = spark.createDataFrame(rows, 'k int, `v, "w"` string').repartitionByRange(5, "k").sortWithinPartitions("k")
    for name, frame, least in (("many", df, 6), ("none", df.limit(0), 1)):
        export_csv(frame, str(tmp_path / name))
        parts = parts_of(spark, str(tmp_path / name))
        assert len(parts) >= least
        whole = tmp_path / f"{name}.csv.gz"
        whole.write_bytes(b"".join((tmp_path / name / p).read_bytes() for p in parts))
        found = list(csv.reader(gzip.decompress(whole.read_bytes()).decode().splitlines()))
        assert found == [["k", 'v, "w"'], *([str(k), v or ""] for k, v in rows if name == "many")]
        back = spark.read.csv(str(whole), header=True, escape='"', schema=df.schema)
        assert sorted(map(tuple, back.collect())) == [r for r in rows if name == "many"]


def test_added_rows_do_not_rewrite_the_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.write("stg_t", spark.range(3).selectExpr("id"))
    tables.add("stg_t", spark.range(2).selectExpr("id + 10 AS id", "'x' AS extra"))
    assert sorted(r.id for r in tables.read("stg_t").collect()) == [0, 1, 2, 10, 11]
    assert sum(r.extra is not None for r in tables.read("stg_t").collect()) == 2
    tables.add("stg_t", spark.range(0).selectExpr("id"))
    assert tables.newest("stg_t", "id") == 11
    assert spark.read.parquet(str(tmp_path / "stg_t" / "a=000000002")).count() == 2


def test_only_touched_partitions_are_written(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    first = spark.createDataFrame([(1, "2024-01", "a"), (2, "2024-02", "b"), (3, "2024-03", "c")], "k int, m string, v string")
    tables.replace_parts("dw_t", first, F.col("m"))
    tables.replace_parts("dw_t", tables.read("dw_t", ["2024-02"]).withColumn("v", F.lit("B")), F.col("m"))
    assert sorted((r.k, r.v) for r in tables.read("dw_t").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert [p.name for p in (tmp_path / "dw_t" / "p=000000002").iterdir() if p.is_dir()] == ["_part=2024-02"]
    assert tables.read("dw_t", ["2030-01"]).count() == 0


@pytest.mark.parametrize(
    "body",
    [
        '[{"i":1}\n,\n{"i":2}\n,\n{"i":3}\n]',
        '[{"i":1},{"i":2}\n,{"i":3}]\n',
        '[\n{"i":1},\n{"i":2},{"i":3}\n]',
        '[{"i":1}, {"i":2}, {"i":3}]',
    ],
)
def test_element_lines_in_any_layout(spark, tmp_path, body):
    (tmp_path / "t__2024-01-01_00.00.00Z__1.json").write_text(body)
    rows = landing.land_element_lines(spark, str(tmp_path), now()).collect()
    assert sorted((r.dw_metadata_file_row_number, r.data) for r in rows) == [(n, f'{{"i":{n}}}') for n in (1, 2, 3)]


def test_element_lines_number_on_over_blocks(spark, tmp_path):
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        body = "[" + "\n,\n".join(f'{{"i":{n}}}' for n in range(1, 201)) + "\n]"
        (tmp_path / "t__2024-01-01_00.00.00Z__1.json").write_text(body)
        rows = landing.land_element_lines(spark, str(tmp_path), now())
        assert rows.rdd.getNumPartitions() > 1
        assert sorted((r.dw_metadata_file_row_number, r.data) for r in rows.collect()) == [(n, f'{{"i":{n}}}') for n in range(1, 201)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
