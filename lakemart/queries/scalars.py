"""Projection and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import seasons, text, times
from lakemart.queries.registry import Source, query


@query(
    """
    SELECT p_partkey, split_part(p_name, ' ', 2) AS noun, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
           left(p_brand, 1) AS initial, nullif(regexp_extract(p_brand, '#([0-9]+)$', 1), '') AS brand_no,
           CASE WHEN regexp_matches(p_name, 'bolt|gear') THEN regexp_extract(p_name, 'bolt|gear') END AS found,
           regexp_replace(p_name, '[aeiou]', '_') AS first_vowel, regexp_replace(p_name, '[aeiou]', '_', 'g') AS all_vowels,
           p_brand || CASE WHEN p_size > 25 THEN p_type END AS strict_join,
           concat(p_brand, CASE WHEN p_size > 25 THEN p_type END) AS loose_join,
           replace(p_brand, '#', '-') AS dashed, p_brand LIKE 'Brand_1%' AS like_one,
           CASE WHEN p_size BETWEEN 10 AND 20 THEN 'mid' WHEN p_size IN (1, 2, 3) THEN 'low' ELSE 'other' END AS band
    FROM part
    """
)
def code_strings(t: Source) -> DataFrame:
    maybe_type = F.when(F.col("p_size") > 25, F.col("p_type"))
    return t.part.select(
        "p_partkey",
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"),
        F.upper("p_name").alias("upper_name"),
        F.lower("p_brand").alias("lower_brand"),
        F.left("p_brand", F.lit(1)).alias("initial"),
        text.find("p_brand", "#([0-9]+)$", 1).alias("brand_no"),
        text.find("p_name", "bolt|gear").alias("found"),
        text.replace_first("p_name", "[aeiou]", "_").alias("first_vowel"),
        F.regexp_replace("p_name", "[aeiou]", "_").alias("all_vowels"),
        F.concat("p_brand", maybe_type).alias("strict_join"),
        text.join_present("p_brand", maybe_type).alias("loose_join"),
        F.replace("p_brand", F.lit("#"), F.lit("-")).alias("dashed"),
        F.col("p_brand").like("Brand_1%").alias("like_one"),
        F.when(F.col("p_size").between(10, 20), "mid").when(F.col("p_size").isin(1, 2, 3), "low").otherwise("other").alias("band"),
    )


@query(
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, CAST(day(o_orderdate) AS INT) AS d,
           strftime(o_orderdate + INTERVAL 30 MINUTE + to_days(CAST(o_orderkey % 7 AS INT)), '%Y-%m-%dT%H:%M:%S.000') AS shifted,
           strftime(date_trunc('minute', o_orderdate + to_seconds(o_orderkey % 3600)), '%Y-%m-%d %H:%M:%S') AS to_minute,
           CAST(o_orderdate AS DATE) AS order_date,
           strftime(greatest(o_orderdate, CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '1998-01-01' END), '%Y-%m-%d') AS not_before,
           CAST(floor(o_totalprice * 100) AS BIGINT) // 1000 AS thousands,
           strftime(make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), 15, 0, 0), '%Y-%m-%d %H:%M:%S') AS at_three,
           hour(o_orderdate + to_seconds(o_orderkey % 86400)) * 3600 + minute(o_orderdate + to_seconds(o_orderkey % 86400)) * 60
             + second(o_orderdate + to_seconds(o_orderkey % 86400)) > 54000 AS after_three
    FROM orders
    """
)
def date_toolkit(t: Source) -> DataFrame:
    day = F.col("o_orderdate").cast("timestamp")
    clock = F.timestamp_seconds(F.unix_timestamp(day) + F.col("o_orderkey") % 86400)
    minute = F.timestamp_seconds(F.unix_timestamp(day) + F.col("o_orderkey") % 3600)
    floor_date = F.when(F.col("o_orderstatus") == "F", F.lit("1998-01-01").cast("timestamp"))
    shifted = times.add_days(day, (F.col("o_orderkey") % 7).cast("int")) + F.expr("INTERVAL 30 MINUTES")
    return t.orders.select(
        "o_orderkey",
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.day(day).alias("d"),
        times.iso_text(shifted).alias("shifted"),
        F.date_format(F.date_trunc("minute", minute), "yyyy-MM-dd HH:mm:ss").alias("to_minute"),
        F.to_date(day).alias("order_date"),
        F.date_format(F.greatest(day, floor_date), "yyyy-MM-dd").alias("not_before"),
        F.call_function("div", F.floor(F.col("o_totalprice") * 100).cast("bigint"), F.lit(1000)).alias("thousands"),
        F.date_format(times.at_time(day, 15), "yyyy-MM-dd HH:mm:ss").alias("at_three"),
        (times.seconds_of_day(clock) > 54000).alias("after_three"),
    )


@query(
    """
    SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS seconds,
           strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS iso_round_trip
    FROM events
    """
)
def epoch_and_iso(t: Source) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.events.select(
        "event_id",
        F.unix_timestamp(times.from_millis(millis)).alias("seconds"),
        F.date_format(F.to_timestamp(iso), "yyyy-MM-dd'T'HH:mm:ss").alias("iso_round_trip"),
    )


@query(
    """
    WITH o AS (SELECT o_orderkey, o_orderdate, year(o_orderdate) AS y FROM orders),
    bounds AS (SELECT *,
        make_timestamp(y, 3, 31 - CAST(dayofweek(make_timestamp(y, 3, 31, 0, 0, 0)) AS INT), 3, 0, 0) AS spring,
        CASE WHEN y >= 1996 THEN make_timestamp(y, 10, 31 - CAST(dayofweek(make_timestamp(y, 10, 31, 0, 0, 0)) AS INT), 4, 0, 0)
             ELSE make_timestamp(y, 9, 30 - CAST(dayofweek(make_timestamp(y, 9, 30, 0, 0, 0)) AS INT), 4, 0, 0) END AS autumn FROM o)
    SELECT o_orderkey, strftime(o_orderdate - CASE WHEN o_orderdate >= spring AND o_orderdate < autumn
           THEN INTERVAL 3 HOUR ELSE INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M:%S') AS instant
    FROM bounds
    """
)
def wall_clock_shift(t: Source) -> DataFrame:
    """Midnights read as Helsinki wall clock; summer time runs from the last
    Sunday of March to the last Sunday of October, before 1996 of September."""
    orders = t.orders
    instant = times.helsinki_wall_clock(F.col("o_orderdate").cast("timestamp"))
    return orders.select("o_orderkey", F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query(
    """
    SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS size_text,
           CASE WHEN p_size > 40 THEN NULL ELSE CAST(p_size AS VARCHAR) || '-' || CAST(p_size + 5 AS VARCHAR) END AS range_text,
           p_size % 2 = 1 AS odd, CAST(NULL AS VARCHAR) AS nothing
    FROM part
    """
)
def casts_and_ranges(t: Source) -> DataFrame:
    size = F.when(F.col("p_size") <= 40, F.col("p_size").cast("double"))
    return t.part.select(
        "p_partkey",
        text.plain_number(size).alias("size_text"),
        F.concat(text.plain_number(size), F.lit("-"), text.plain_number(size + 5)).alias("range_text"),
        (F.col("p_size") % 2).cast("boolean").alias("odd"),
        F.lit(None).cast("string").alias("nothing"),
    )


@query(
    """
    SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'O' THEN NULL
             WHEN o_orderstatus = 'F' OR month(o_orderdate) < 8 THEN 'kausi_k#1' ELSE 'kausi_s#1' END AS season,
        CASE o_orderstatus WHEN 'O' THEN '{"type":"henkkoht"}'
             ELSE '{"type":"kausivuosi","koulutuksenAlkamisvuosi":' || CAST(year(o_orderdate) AS VARCHAR)
                  || ',"koulutuksenAlkamiskausiKoodiUri":"'
                  || CASE WHEN o_orderstatus = 'F' OR month(o_orderdate) < 8 THEN 'kausi_k#1' ELSE 'kausi_s#1' END || '"}'
             END AS start
    FROM orders
    """
)
def start_season(t: Source) -> DataFrame:
    """Year-and-season, exact-date and personal-plan documents made alike."""
    kind = F.when(F.col("o_orderstatus") == "F", seasons.BY_SEASON).when(F.col("o_orderstatus") == "P", seasons.BY_DATE)
    document = F.to_json(
        F.struct(
            F.coalesce(kind, F.lit("henkilokohtainen suunnitelma")).alias("alkamiskausityyppi"),
            F.when(kind == seasons.BY_SEASON, F.year("o_orderdate").cast("string")).alias("koulutuksenAlkamisvuosi"),
            F.when(kind == seasons.BY_SEASON, F.lit("kausi_k#1")).alias("koulutuksenAlkamiskausiKoodiUri"),
            F.when(kind == seasons.BY_DATE, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")).alias("koulutuksenAlkamispaivamaara"),
        )
    )
    rows = t.orders.withColumn("document", document)
    return rows.select(
        "o_orderkey", seasons.start_of("document")["season"].alias("season"), seasons.start_json("document").alias("start")
    )


@query(
    """
    WITH x AS (SELECT o_orderkey, o_orderdate + INTERVAL 10 HOUR AS published, CAST(o_orderkey % 20 AS INT) AS days,
                      TIMESTAMP '1998-06-15 15:00:00' AS common FROM orders),
    y AS (SELECT *, greatest(common, published + to_days(days)) AS latest FROM x)
    SELECT o_orderkey, strftime(date_trunc('day', latest) + INTERVAL 15 HOUR
        + CASE WHEN hour(latest) * 60 + minute(latest) > 900 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END,
        '%Y-%m-%d %H:%M:%S') AS deadline
    FROM y
    """
)
def acceptance_deadline(t: Source) -> DataFrame:
    published = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 10 HOURS")
    deadline = seasons.acceptance_deadline(
        published, (F.col("o_orderkey") % 20).cast("int"), F.lit("1998-06-15 15:00:00").cast("timestamp")
    )
    return t.orders.select("o_orderkey", F.date_format(deadline, "yyyy-MM-dd HH:mm:ss").alias("deadline"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def star_except(t: Source) -> DataFrame:
    return t.customer.drop("c_nationkey", "c_acctbal")


@query(
    """
    SELECT c_custkey, md5(concat_ws('-', CAST(c_custkey AS VARCHAR), c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR))) AS content_hash
    FROM customer
    """
)
def columns_by_prefix(t: Source) -> DataFrame:
    from lakemart.functions.keys import surrogate_key
    from lakemart.operators.history import hash_columns

    customers = t.customer.drop("c_acctbal").withColumn("dw_metadata_filename", F.lit("x"))
    return customers.select("c_custkey", surrogate_key(*hash_columns(customers)).alias("content_hash"))
