import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.sources import arrays, landing


def now():
    return F.lit("2024-06-01").cast("timestamp")


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of few bytes."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def document(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice(['a"b', "\\", 'x\\"}', "},{", "[", "ÄÖ ☃ 𝄞", "", "\n", '"', "\\\\\"", "{" * 5, "] ,"])
    if kind == 1:
        return rng.choice([1, -2.5, True, None, 10**12])
    if kind in (2, 3):
        return "w" * rng.randrange(40)
    if kind == 4:
        return [document(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}{rng.choice(['', '}', chr(34)])}": document(rng, depth + 1) for i in range(rng.randrange(4))}


KEYS = ["source", "raw_table", "dw_metadata_filename", "dw_metadata_file_row_number", "data", "dw_metadata_source_timestamp_at"]


def landed(df):
    return sorted(map(tuple, df.select(*KEYS).collect()), key=repr)


def test_every_layout_gives_the_rows_and_numbers_of_whole_files(spark, tmp_path, small_blocks):
    rng = random.Random(3)
    layouts = [
        {}, {"indent": 2}, {"indent": 0}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": "\t"}, {"separators": ("  ,\r\n", " : ")},
    ]
    folder = tmp_path / "src"
    folder.mkdir()
    for n, options in enumerate(layouts):
        docs = [{"id": i, "d": document(rng)} for i in range(150)]
        (folder / f"t__2024-05-0{n + 1}_10.00.00Z__1.json").write_bytes(("\n " * (n % 2) + json.dumps(docs, **options) + "\n" * (n % 3)).encode())
    long = [{"t": "},{[" * 800}, {"u": "\\\"" * 900}, {"v": [[{"w": "x" * 2_000}]]}]
    (folder / "long__2024-06-01_10.00.00Z__1.json").write_text(json.dumps(long))
    mixed = [1, "a,b", None, [1, [2]], {"a": {}}, [], {}, True, "}"]
    (folder / "mixed__2024-06-02_10.00.00Z__1.json").write_text(json.dumps(mixed))
    for n, text in enumerate(["", " \n", "[]", " [ \n ] \n", "[{}]"]):
        (folder / f"few__2024-07-0{n + 1}_10.00.00Z__1.json").write_text(text)
    want = landed(landing.land_files(spark, str(folder), now()))
    got = arrays.land_arrays(spark, str(folder), now())
    assert landed(got) == want and len(want) == 150 * len(layouts) + len(long) + len(mixed) + 1
    # start states are broadcast in rounds
    assert landed(arrays.land_arrays(spark, str(folder), now(), states=40)) == want


def test_one_line_of_many_blocks_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "s").mkdir()
    body = json.dumps([{"n": n, "t": f"text }} {n} \"" * 5} for n in range(5_000)])
    (tmp_path / "s" / "t__2024-01-01_00.00.00Z__1.json").write_text(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = arrays.land_arrays(spark, str(tmp_path), now())
        assert len(body) > 400_000
        got = rows.select("dw_metadata_file_row_number", F.get_json_object("data", "$.n").cast("int").alias("n")).collect()
        assert sorted(map(tuple, got)) == [(n + 1, n) for n in range(5_000)]
        pieces = spark.read.format("text").option("lineSep", "}").load(str(tmp_path / "s"))
        assert pieces.rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows.first().dw_metadata_source_timestamp_at == datetime(2024, 1, 1)


@pytest.mark.parametrize("text", ['{"a":1}', '{"a":1}\n', '[{"a":1}', '[{"a":1},', '[{"a":"x}]', '[{"a":1}]]', "[1,,2]", "[,1]", "[1,]", '"[]"', '[{"a":1}] [2]'])
def test_what_is_not_one_array_is_refused(spark, tmp_path, text):
    (tmp_path / "t__2024-05-01_10.30.00Z__1.json").write_text(text)
    with pytest.raises(Exception, match="JSON array|empty element|MALFORMED"):
        arrays.land_arrays(spark, str(tmp_path), now()).collect()


def test_no_files_no_rows(spark, tmp_path):
    assert arrays.land_arrays(spark, str(tmp_path), now()).collect() == []
