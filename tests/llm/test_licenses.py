import textwrap

import duckdb

from lakemart.llm import licenses as L
from tests.llm.corpus import empty_documents, odd_documents


def test_templates_bounds_and_ties(spark):
    rows = [
        (1, "Some words.\nReleased under the MIT License."), (2, "released   under THE mit licence"), (3, "All rights reserved.\nLicensed under CC BY-NC 4.0."),
        (4, L.TEMPLATES[2][1].replace(", ", ",\n", 3)), (5, "under the"), (6, None), (7, "Licensed under the Apache License, Version 2.0, as we said, and more words."),
    ]
    found = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].license for i in range(1, 8)] == ["MIT", None, "CC-BY-NC-4.0", "MIT", None, None, None]
    assert found[1].dice == 1.0 and found[3].n_matches == 3 and found[6].n_matches == 0


def wrapped(text, width):
    return "\n".join(textwrap.wrap(text, width))


def test_paragraphs_of_several_lines(spark):
    long = max((t for n, t in L.TEMPLATES if n == "MIT"), key=len)
    other = "\n".join(f"line {k} of some other text that says nothing of the kind" for k in range(40))
    rows = [
        (1, f"{wrapped(long, 72)}\n\n{other}"), (2, f"{other}\n \t\r\n\n{wrapped(long, 30)}\n"), (3, f"{long}\n\n{other}"), (4, f"\n{long}\n\n{other}\n\n"),
        (5, other), (6, f"{other}\n\n{other}"), (7, wrapped(long, 40)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.license, r.n_matches) for r in L.scan_licenses(docs).collect()}
    assert found == {1: ("MIT", 1), 2: ("MIT", 1), 3: ("MIT", 1), 4: ("MIT", 1), 5: (None, 0), 6: (None, 0), 7: ("MIT", 1)}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(f"SELECT doc_id, license, n_matches FROM ({L.oracle()})").fetchall()
    assert {i: (name, n) for i, name, n in want} == found


def test_odd_rows_against_sql(spark):
    docs = odd_documents(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    extra = spark.createDataFrame([(100 + k, f"x y z\n{t}\n{t} again") for k, (_, t) in enumerate(L.TEMPLATES)], "doc_id long, text string")
    docs = docs.select("doc_id", "text", "license").unionByName(extra, allowMissingColumns=True)
    frame = docs.select("doc_id", "text").toPandas()
    con = duckdb.connect()
    con.register("documents", frame)
    want = sorted(con.execute(f"SELECT doc_id, n_matches, license, dice FROM ({L.oracle()})").fetchall())
    got = L.scan_licenses(docs)
    assert got.columns.count("license") == 1
    assert sorted(map(tuple, got.select("doc_id", "n_matches", "license", "dice").collect())) == want
    assert L.scan_licenses(odd_documents(spark)).count() == odd_documents(spark).count()
    assert L.scan_licenses(empty_documents(spark)).count() == 0
