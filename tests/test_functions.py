from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.functions import jsonx, seasons, text, times
from lakemart.functions.keys import surrogate_key


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(1).alias("_"))
    return df.select(column.alias("r")).first()["r"]


def test_key_tells_null_from_text(spark):
    import hashlib

    got = one(spark, surrogate_key("a", "b", "c"), a="x", b=None, c=3)
    assert got == hashlib.md5(b"x-_dbt_utils_surrogate_key_null_-3").hexdigest()
    assert one(spark, surrogate_key("a"), a=None) != one(spark, surrogate_key("a"), a="")


@pytest.mark.parametrize(
    "document, keys, expected",
    [
        ('{"a":1}', ("a",), "1"),
        ('{"a":null}', ("a",), None),
        ('{"b":1}', ("a",), None),
        ('{"x y-z":"v"}', ("x y-z",), "v"),
        ('{"base-education–country":"246"}', ("base-education–country",), "246"),
        ('{"a":[["2001"]]}', ("a", 0, 0), "2001"),
        ('{"a":{"b":[1,2]}}', ("a", "b"), "[1,2]"),
        (None, ("a",), None),
    ],
)
def test_path(spark, document, keys, expected):
    assert one(spark, jsonx.at("d", *keys), d=document) == expected


def test_json_null_key_exists_but_has_no_value(spark):
    assert one(spark, jsonx.has_key("d", "a"), d='{"a":null}') is True
    assert one(spark, jsonx.at("d", "a"), d='{"a":null}') is None


def test_holds_reads_arrays_and_objects(spark):
    assert one(spark, jsonx.holds("d", "x"), d='["x","y"]') is True
    assert one(spark, jsonx.holds("d", "x"), d='{"x":1}') is True
    assert one(spark, jsonx.holds("d", "x"), d='["y"]') is False
    assert one(spark, jsonx.holds("d", "x"), d=None) is None


def test_empty_array_has_no_elements(spark):
    assert one(spark, jsonx.elements("d"), d="[]") == []
    assert one(spark, jsonx.length("d"), d="[]") == 0


def test_array_of_documents_keeps_nulls(spark):
    df = spark.createDataFrame([(['{"a":1}', None],)], "d array<string>")
    assert df.select(jsonx.array_of(F.col("d"))).first()[0] == '[{"a":1},null]'


def test_names_borrow_missing_languages(spark):
    got = one(spark, jsonx.names("fi", "sv", "en"), fi=None, sv="s", en=None)
    assert got == '{"en":"s","sv":"s","fi":"s"}'


def test_canonical_text_ignores_order_and_space(spark):
    assert one(spark, jsonx.canonical("d"), d='{ "b" : 1, "a":"x"}') == '{"a":"x","b":1}'


def test_first_match_replaced_only(spark):
    assert one(spark, text.replace_first("a", "[aeiou]", "_"), a="banana") == "b_nana"
    assert one(spark, text.find("a", "z+"), a="banana") is None


@pytest.mark.parametrize("value, expected", [(180.0, "180"), (22.5, "22.5"), (None, None), (0.0, "0")])
def test_number_text(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(text.plain_number("v")).first()[0] == expected


def test_code_uri_parts(spark):
    assert one(spark, text.code_value("u"), u="koulutus_671101#12") == "671101"
    assert one(spark, text.code_uri("u"), u="koulutus_671101#12") == "koulutus_671101"
    assert one(spark, text.code_version("u"), u="koulutus_671101#12") == 12
    assert one(spark, text.code_version("u"), u="koulutus_671101") is None


def test_millis_are_cut_to_seconds(spark):
    assert one(spark, F.unix_timestamp(times.from_millis("m")), m=1700000000999) == 1700000000


@pytest.mark.parametrize(
    "wall, instant",
    [
        ("2024-01-15 12:00:00", "2024-01-15 10:00:00"),
        ("2024-07-15 12:00:00", "2024-07-15 09:00:00"),
        ("2024-03-31 02:59:59", "2024-03-31 00:59:59"),
        ("2024-03-31 04:00:00", "2024-03-31 01:00:00"),
        ("2024-10-27 04:00:00", "2024-10-27 02:00:00"),
        ("2024-10-27 03:30:00", "2024-10-27 00:30:00"),
    ],
)
def test_wall_clock_around_summer_time(spark, wall, instant):
    got = one(spark, times.helsinki_wall_clock(F.col("t").cast("timestamp")), t=wall)
    assert str(got) == instant


def deadline(spark, published, days, common):
    df = spark.createDataFrame([(published, days, common)], "p timestamp, d int, c timestamp")
    return df.select(seasons.acceptance_deadline(F.col("p"), F.col("d"), F.col("c"))).first()[0]


def test_deadline_is_common_one_for_early_publication(spark):
    assert deadline(spark, datetime(2024, 6, 1, 9), 14, datetime(2024, 7, 11, 15)) == datetime(2024, 7, 11, 15)


def test_deadline_moves_to_next_day_after_the_hour(spark):
    assert deadline(spark, datetime(2024, 7, 1, 16, 30), 14, datetime(2024, 7, 11, 15)) == datetime(2024, 7, 16, 15)
    assert deadline(spark, datetime(2024, 7, 1, 14, 30), 14, datetime(2024, 7, 11, 15)) == datetime(2024, 7, 15, 15)


def test_deadline_without_publication_or_common_time(spark):
    assert deadline(spark, None, 14, datetime(2024, 7, 11, 15)) == datetime(2024, 7, 11, 15)
    assert deadline(spark, datetime(2024, 7, 1), 14, None) is None


@pytest.mark.parametrize(
    "document, expected",
    [
        (None, None),
        ('{"alkamiskausityyppi":"henkilokohtainen suunnitelma"}', '{"type":"henkkoht"}'),
        ("{}", '{"type":"henkkoht"}'),
        ('{"alkamiskausityyppi":"alkamiskausi ja -vuosi"}', "{}"),
        (
            '{"alkamiskausityyppi":"alkamiskausi ja -vuosi","koulutuksenAlkamisvuosi":"2024","koulutuksenAlkamiskausiKoodiUri":"kausi_s#1"}',
            '{"type":"kausivuosi","koulutuksenAlkamisvuosi":2024,"koulutuksenAlkamiskausiKoodiUri":"kausi_s#1"}',
        ),
        (
            '{"alkamiskausityyppi":"tarkka alkamisajankohta","koulutuksenAlkamispaivamaara":"2024-07-31T09:00"}',
            '{"type":"kausivuosi","koulutuksenAlkamisvuosi":2024,"koulutuksenAlkamiskausiKoodiUri":"kausi_k#1"}',
        ),
        (
            '{"alkamiskausityyppi":"tarkka alkamisajankohta","koulutuksenAlkamispaivamaara":"2024-08-01T09:00"}',
            '{"type":"kausivuosi","koulutuksenAlkamisvuosi":2024,"koulutuksenAlkamiskausiKoodiUri":"kausi_s#1"}',
        ),
    ],
)
def test_start_season(spark, document, expected):
    assert one(spark, seasons.start_json("d"), d=document) == expected
