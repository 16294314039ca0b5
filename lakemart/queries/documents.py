"""JSON queries.  Documents are built from table rows and taken apart again,
so that the SQL twin can work on the plain rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import jsonx, text
from lakemart.operators import aggregates
from lakemart.queries.registry import Source, query
from lakemart.sources.shred import Shape, fields, shred

# how many options a part document lists
OPTIONS_PER_PART = 4


def part_documents(t: Source) -> DataFrame:
    """One nested document per part: names, a code uri, 0-3 options, answers."""
    numbers = F.expr(f"filter(sequence(1, {OPTIONS_PER_PART}), n -> n <= p_size % {OPTIONS_PER_PART})")
    options = F.transform(
        numbers,
        lambda n: F.struct(
            n.alias("nr"),
            (n * F.col("p_size")).alias("amount"),
            F.when(n == 2, F.col("p_brand")).alias("brand"),
        ),
    )
    document = F.struct(
        F.col("p_partkey").alias("oid"),
        F.struct(F.col("p_name").alias("fi"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("sv")).alias("nimi"),
        F.concat(F.lit("brand_"), F.lower("p_brand"), F.lit("#"), F.col("p_size")).alias("koodiUri"),
        options.alias("options"),
        F.array("p_type", "p_brand").alias("tags"),
        F.create_map(
            F.concat(F.lit("size_"), F.col("p_size")), F.col("p_type"),
            F.lit("first-education–country"), F.col("p_brand"),
        ).alias("answers"),
    )
    return t.part.select("p_partkey", "p_size", "p_type", "p_brand", F.to_json(document).alias("data"))


@query(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
           json_extract_string(props, '$.absent') AS absent
    FROM events
    """
)
def json_extract(t: Source) -> DataFrame:
    return t.events.select(
        "event_id", jsonx.at("props", "k").cast("int").alias("k"), jsonx.at("props", "absent").alias("absent")
    )


@query(
    """
    SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INT)) AS BIGINT) AS total,
           count(*) AS n
    FROM events GROUP BY event_type
    """
)
def json_typed_record(t: Source) -> DataFrame:
    typed = t.events.select("event_type", jsonx.record("props", "k int").alias("p"))
    return typed.groupBy("event_type").agg(F.sum("p.k").alias("total"), F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT event_id, key, json_extract_string(props, '$.' || key) AS value
    FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
    """
)
def json_kv_long(t: Source) -> DataFrame:
    return t.events.select("event_id", F.explode(jsonx.entries("props")).alias("key", "value"))


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def json_object_keys(t: Source) -> DataFrame:
    return t.events.select(F.explode(jsonx.keys_of("props")).alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    f"""
    SELECT p_partkey, n AS nr, CAST(n * p_size AS INT) AS amount, CASE WHEN n = 2 THEN p_brand END AS brand
    FROM (SELECT p_partkey, p_size, p_brand,
                 CAST(unnest(range(1, p_size % {OPTIONS_PER_PART} + 1)) AS INT) AS n FROM part)
    """
)
def json_recordset(t: Source) -> DataFrame:
    options = jsonx.records(jsonx.at("data", "options"), "nr int, amount int, brand string")
    return part_documents(t).select("p_partkey", F.inline(options))


@query(
    """
    SELECT p_partkey, 1 AS place, p_type AS tag FROM part
    UNION ALL SELECT p_partkey, 2, p_brand FROM part
    """
)
def json_elements_ordinal(t: Source) -> DataFrame:
    tags = part_documents(t).select("p_partkey", F.posexplode(jsonx.elements(jsonx.at("data", "tags"))).alias("pos", "tag"))
    return tags.select("p_partkey", (F.col("pos") + 1).alias("place"), "tag")


@query(
    f"""
    SELECT p_partkey, n AS nr, CAST(n * p_size AS INT) AS amount
    FROM (SELECT p_partkey, p_size, CAST(unnest(range(1, p_size % {OPTIONS_PER_PART} + 1)) AS INT) AS n FROM part)
    """
)
def json_lockstep_explode(t: Source) -> DataFrame:
    one = part_documents(t).select("p_partkey", F.explode(jsonx.elements(jsonx.at("data", "options"))).alias("o"))
    return one.select("p_partkey", jsonx.at("o", "nr").cast("int").alias("nr"), jsonx.at("o", "amount").cast("int").alias("amount"))


@query(
    f"""
    SELECT p_partkey, p_type AS first_tag, CAST(p_size % {OPTIONS_PER_PART} AS INT) AS options,
           CASE WHEN p_size % {OPTIONS_PER_PART} > 0 THEN 'some' ELSE 'none' END AS guard
    FROM part
    """
)
def json_array_access(t: Source) -> DataFrame:
    size = jsonx.length(jsonx.at("data", "options"))
    return part_documents(t).select(
        "p_partkey",
        jsonx.at("data", "tags", 0).alias("first_tag"),
        size.alias("options"),
        F.when(size > 0, "some").otherwise("none").alias("guard"),
    )


@query(
    f"""
    SELECT p_partkey, p_type = 'ECONOMY' OR p_brand = 'ECONOMY' AS has_tag,
           p_size = 7 AS has_key, p_size IN (7, 8) AS has_any,
           p_size % {OPTIONS_PER_PART} >= 2 AND p_size * 2 > 20 AS path_exists,
           p_size % {OPTIONS_PER_PART} >= 2 AS has_brand
    FROM part
    """
)
def json_containment(t: Source) -> DataFrame:
    docs = part_documents(t).select(
        "p_partkey",
        jsonx.at("data", "tags").alias("tags"),
        jsonx.at("data", "answers").alias("answers"),
        jsonx.records(jsonx.at("data", "options"), "nr int, amount int, brand string").alias("options"),
    )
    return docs.select(
        "p_partkey",
        jsonx.has_element("tags", "ECONOMY").alias("has_tag"),
        jsonx.has_key("answers", "size_7").alias("has_key"),
        jsonx.has_any_key("answers", ["size_7", "size_8"]).alias("has_any"),
        F.exists("options", lambda o: (o["nr"] == 2) & (o["amount"] > 20)).alias("path_exists"),
        F.exists("options", lambda o: o["brand"].isNotNull()).alias("has_brand"),
    )


@query(
    f"""
    SELECT p_partkey, CAST(n * p_size AS INT) AS amount
    FROM (SELECT p_partkey, p_size, unnest(range(1, p_size % {OPTIONS_PER_PART} + 1)) AS n FROM part)
    WHERE n * p_size > 30
    """
)
def json_path_query(t: Source) -> DataFrame:
    options = jsonx.records(jsonx.at("data", "options"), "nr int, amount int")
    hits = F.filter(options, lambda o: o["amount"] > 30)
    return part_documents(t).select("p_partkey", F.explode(F.transform(hits, lambda o: o["amount"])).alias("amount"))


@query(
    """
    SELECT p_partkey, p_type AS answer, p_brand AS country, 'size_' || CAST(p_size AS VARCHAR) AS question
    FROM part
    """
)
def json_dynamic_key(t: Source) -> DataFrame:
    docs = part_documents(t).withColumn("question", F.concat(F.lit("size_"), F.col("p_size")))
    answers = jsonx.at("data", "answers")
    return docs.select(
        "p_partkey",
        "question",
        jsonx.value_of(answers, F.col("question")).alias("answer"),
        jsonx.at("data", "answers", "first-education–country").alias("country"),
    )


@query(
    """
    SELECT p_partkey,
           '{"fi":"' || p_name || '","sv":' || CASE WHEN p_size > 25 THEN '"' || p_type || '"' ELSE 'null' END || '}' AS kept,
           '{"fi":"' || p_name || '"' || CASE WHEN p_size > 25 THEN ',"sv":"' || p_type || '"' ELSE '' END || '}' AS stripped,
           '{"en":"' || p_name || '","sv":"' || CASE WHEN p_size > 25 THEN p_type ELSE p_name END || '","fi":"' || p_name || '"}' AS names
    FROM part
    """
)
def json_build(t: Source) -> DataFrame:
    sv = F.when(F.col("p_size") > 25, F.col("p_type"))
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        jsonx.build(fi=name, sv=sv).alias("kept"),
        jsonx.build_named([("fi", name), ("sv", sv)], keep_nulls=False).alias("stripped"),
        jsonx.names(name, sv, F.lit(None).cast("string")).alias("names"),
    )


@query(
    """
    SELECT l_suppkey, '{' || string_agg('"' || l_returnflag || '":' || CAST(n AS VARCHAR), ',' ORDER BY l_returnflag) || '}' AS counts
    FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY l_suppkey
    """
)
def json_object_agg(t: Source) -> DataFrame:
    counts = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.object_per_key(counts, ["l_suppkey"], "l_returnflag", "n", "n", "counts")


@query(
    """
    SELECT o_custkey, '{' || string_agg('"' || o_orderpriority || '":' || CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderpriority) || '}' AS last_orders
    FROM (SELECT o_custkey, o_orderpriority, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2) GROUP BY o_custkey
    """
)
def json_object_agg_last_wins(t: Source) -> DataFrame:
    orders = t.orders.withColumn("arrival", F.col("o_orderkey"))
    return aggregates.object_per_key(orders, ["o_custkey"], "o_orderpriority", "o_orderkey", "arrival", "last_orders")


@query(
    """
    SELECT c_nationkey, '[' || string_agg('{"segment":"' || c_mktsegment || '","customers":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY c_mktsegment) || ']' AS segments
    FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY c_nationkey
    """
)
def json_array_agg_ordered(t: Source) -> DataFrame:
    counts = t.customer.groupBy("c_nationkey", F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    rows = F.array_sort(F.collect_list(F.struct("segment", "customers")))
    return counts.groupBy("c_nationkey").agg(jsonx.to_array(rows).alias("segments"))


@query("SELECT p_partkey, '{\"a\":' || CAST(p_size AS VARCHAR) || ',\"b\":\"' || p_type || '\"}' AS document, true AS equal FROM part")
def json_canonical_equality(t: Source) -> DataFrame:
    spaced = F.format_string('{ "b" : "%s" , "a" : %d }', "p_type", "p_size")
    tight = F.format_string('{"a":%d,"b":"%s"}', "p_size", "p_type")
    return t.part.select(
        "p_partkey",
        jsonx.canonical(spaced).alias("document"),
        (jsonx.canonical(spaced) == jsonx.canonical(tight)).alias("equal"),
    )


@query(
    """
    SELECT p_partkey, '["' || replace(p_name, ' ', '","') || '"]' AS words, replace(p_name, ' ', ',') AS plain
    FROM part
    """
)
def csv_json_array(t: Source) -> DataFrame:
    words = F.to_json(F.split(F.replace("p_name", F.lit(" "), F.lit(",")), ","))
    return t.part.select("p_partkey", words.alias("words"), text.strip_json_list(words).alias("plain"))


@query(
    """
    SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k,
           epoch_ms(date_trunc('second', ts)) AS ts_millis,
           md5(concat_ws('-', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR))) AS event_key
    FROM events
    """
)
def json_shred(t: Source) -> DataFrame:
    """Raw envelope of nested documents to typed columns with a field list."""
    document = F.struct(
        F.col("event_id").alias("oid"),
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("type")).alias("actor"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("modified"),
        F.from_json("props", "k int").alias("props"),
    )
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    raw = t.events.select(
        F.to_json(document).alias("data"),
        now.alias("dw_metadata_source_timestamp_at"),
        now.alias("dw_metadata_dbt_copied_at"),
        F.lit("events__2024-02-01_00.00.00Z__1.json").alias("dw_metadata_filename"),
        F.col("event_id").cast("int").alias("dw_metadata_file_row_number"),
    )
    shape = Shape(
        raw="events",
        fields=fields(
            "oid:bigint=event_id actor/id:bigint=user_id actor/type=event_type props:json props/k:int modified:time=muokattu"
        ),
        key=("event_key", ("event_id", "user_id")),
    )
    return shred(raw, shape, now).select(
        "event_id", "user_id", "event_type", "k", F.unix_millis("muokattu").alias("ts_millis"), "event_key"
    )


@query(
    """
    SELECT doc_id, CAST(i AS INT) AS line_no, length(line) AS n_chars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
    """
)
def text_lines_ordinal(t: Source) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", (F.col("pos") + 1).alias("line_no"), F.length("line").alias("n_chars").cast("bigint"))


@query(
    f"""
    SELECT p_partkey, n AS nr
    FROM (SELECT p_partkey, unnest(CASE WHEN p_size % {OPTIONS_PER_PART} = 0 THEN [CAST(NULL AS BIGINT)]
          ELSE range(1, p_size % {OPTIONS_PER_PART} + 1) END) AS n FROM part)
    """
)
def outer_explode(t: Source) -> DataFrame:
    options = jsonx.records(jsonx.at("data", "options"), "nr bigint")
    return part_documents(t).select("p_partkey", F.explode_outer(options).alias("o")).select("p_partkey", "o.nr")
