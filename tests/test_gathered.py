from lakemart.sinks.gathered import Gathered
from lakemart.sinks.versions import Tables


def test_batches_are_merged_ever_more_rarely(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), bucket_bytes=1 << 10)
    held = Gathered(tables, "t", ("k",), "at")
    want, written = {}, []
    for n in range(10):
        rows = [(k, n if k % 3 else -n, f"{n}") for k in range(n * 5, n * 5 + 200)]
        for k, at, value in rows:
            if k not in want or at > want[k][0]:
                want[k] = (at, value)
        held.add(spark.createDataFrame(rows, "k long, at long, value string").coalesce(1))
        written.append(tables.version("t"))
        assert {r.k: (r.at, r.value) for r in held.read().collect()} == want
    assert len(set(written)) <= 6
    held.merge()
    assert {r.k: (r.at, r.value) for r in tables.read("t").collect()} == want
    assert tables.read("t").count() == len(want)


def test_a_batch_added_again_changes_nothing(spark, tmp_path):
    held = Gathered(Tables(spark, str(tmp_path)), "t", ("k",), "at")
    batch = spark.createDataFrame([(1, 5, "a"), (None, 1, "b")], "k long, at long, value string")
    for _ in range(3):
        held.add(batch)
    held.merge()
    held.merge()
    assert sorted(map(tuple, held.read().collect()), key=str) == [(1, 5, "a"), (None, 1, "b")]
