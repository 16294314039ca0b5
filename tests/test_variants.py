import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.plans.shapes import SHAPES
from lakemart.sources import shred, variants
from lakemart.sources.landing import ENVELOPE
from lakemart.sources.shred import Shape, fields
from tests import documents as d

def now():
    return F.lit("2024-06-01").cast("timestamp")


def raw(rows, *texts):
    return rows([(t, datetime(2024, 1, 1), datetime(2024, 1, 2), "f", i) for i, t in enumerate(texts)], ENVELOPE)


def test_json_null_is_kept_apart(rows):
    landed = variants.landed(raw(rows, '{"a": null, "b": {"c": [1, null]}}', '{"b": {"c": []}}', '{"a": "x", "b": null}', None))
    got = landed.orderBy("dw_metadata_file_row_number").select(
        variants.is_there("data", "a"), variants.is_null("data", "a"), variants.json_text("data", "a"), variants.at("data", "a", kind="string"),
        variants.json_text("data", "b", "c"), variants.json_text("data", "b"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, True, "null", None, "[1,null]", '{"c":[1,null]}'),
        (False, False, None, None, "[]", '{"c":[]}'),
        (True, False, '"x"', "x", None, "null"),
        (False, False, None, None, None, None),
    ]


def test_paths_take_any_key(rows):
    landed = variants.landed(raw(rows, json.dumps({"a.b": {"it's": [5, {"ö–ä": "x"}], 'q"q': 1, "\\": 2, "both'\"?": {"x": 3}}})))
    (r,) = landed.select(
        variants.at("data", "a.b", "it's", 0, kind="int"), variants.at("data", "a.b", "it's", 1, "ö–ä", kind="string"),
        variants.at("data", "a.b", 'q"q', kind="int"), F.size(variants.elements("data", "a.b", "it's")),
        variants.at("data", "a.b", "\\", kind="int"), variants.at("data", "a.b", "both'\"?", "x", kind="int"),
    ).collect()
    assert tuple(r) == (5, "x", 1, 2, 2, 3)


def test_values_survive_storage(spark, rows, tmp_path):
    variants.landed(raw(rows, '{"a": null, "n": 12345678901234567890, "t": "ä"}')).write.parquet(str(tmp_path / "v"))
    back = spark.read.parquet(str(tmp_path / "v"))
    (r,) = back.select(variants.is_null("data", "a"), variants.at("data", "n", kind="string"), variants.at("data", "t", kind="string")).collect()
    assert tuple(r) == (True, "12345678901234567890", "ä")


def test_text_that_is_no_json_is_refused_at_landing(rows):
    with pytest.raises(Exception, match="MALFORMED|parse"):
        variants.landed(raw(rows, '{"a": ')).collect()
    with pytest.raises(TypeError):
        variants.shred(raw(rows, "{}"), Shape("t", fields("a")), now())


@pytest.mark.parametrize("name", sorted(set(d.FIRST) | set(d.SECOND)))
def test_shapes_read_the_same_from_values_as_from_text(spark, name):
    """Fields of all stages with documents; only JSON null in JSON fields differs."""
    df = d.raw(spark, name, [*d.FIRST.get(name, []), *d.SECOND.get(name, [])], d.FIRST_AT)
    shape = SHAPES[name]
    a, b = shred.shred(df, shape, now()), variants.shred(variants.landed(df), shape, now())
    assert a.dtypes == b.dtypes
    kinds = {f.column: f.type for f in shape.fields}

    def plain(r):
        out = []
        for c in a.columns:
            v = r[c]
            if v is not None and (kinds.get(c) == "json" or c == "data"):
                v = json.dumps(json.loads(v), sort_keys=True)
                v = None if v == "null" else v
            out.append(v)
        return tuple(out)

    assert sorted(map(plain, a.collect()), key=repr) == sorted(map(plain, b.collect()), key=repr)
