"""Tables in versions: atomic, partial, once per batch."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageprism.sources import snapshots as s

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def part():
    return F.substring("k", 1, 1)


def frame(spark, **rows):
    return spark.createDataFrame(list(rows.items()), SCHEMA)


def latest(old, new):
    return old.withColumn("g", F.lit(0)).union(new.withColumn("g", F.lit(1))).groupBy("k").agg(F.max_by("v", "g").alias("v"))


def rows(spark, path, version=None):
    return {r.k: r.v for r in s.read_snapshot(spark, path, SCHEMA, version).collect()}


def test_untouched_parts_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    assert rows(spark, path) == {} and s.manifest(spark, path).rows == 0
    one = s.upsert(spark, path, frame(spark, a1=1, a2=1, b1=1), part(), SCHEMA, latest)
    two = s.upsert(spark, path, frame(spark, a2=2, c1=2), part(), SCHEMA, latest)
    assert one.parts["b"] == two.parts["b"] and one.parts["a"]["folder"] != two.parts["a"]["folder"]
    assert rows(spark, path) == {"a1": 1, "a2": 2, "b1": 1, "c1": 2} and two.rows == 4
    assert rows(spark, path, 1) == {"a1": 1, "a2": 1, "b1": 1}
    assert {n: p["rows"] for n, p in two.parts.items()} == {"a": 2, "b": 1, "c": 1}
    only = s.read_snapshot(spark, path, SCHEMA, wanted="b".__eq__)
    assert [r.k for r in only.collect()] == ["b1"] and all("_part=b" in f for f in only.inputFiles())
    with pytest.raises(ValueError):
        rows(spark, path, 9)


def test_nothing_new_makes_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    s.upsert(spark, path, frame(spark, a1=1), part(), SCHEMA, latest)
    assert s.upsert(spark, path, spark.createDataFrame([], SCHEMA), part(), SCHEMA, latest).version == 1


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    add = lambda old, new: old.union(new)
    for number in (0, 0, 1, 0):
        s.upsert(spark, path, frame(spark, a=number), part(), SCHEMA, add, batch=("stream", number))
    assert s.manifest(spark, path).rows == 2 and s.manifest(spark, path).batches == {"stream": 1}
    s.upsert(spark, path, frame(spark, a=5), part(), SCHEMA, add, batch=("other", 0))
    assert s.manifest(spark, path).rows == 3


def test_a_reader_sees_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    s.upsert(spark, path, frame(spark, a1=1, b1=1), part(), SCHEMA, latest)
    reader = s.read_snapshot(spark, path, SCHEMA)
    s.upsert(spark, path, frame(spark, a1=2, b1=2), part(), SCHEMA, latest)
    assert {r.v for r in reader.collect()} == {1} and set(rows(spark, path).values()) == {2}


def test_writers_at_once(spark, tmp_path):
    path, failures = str(tmp_path / "t"), []

    def write(i):
        try:
            s.upsert(spark, path, frame(spark, **{f"a{i}": i}), part(), SCHEMA, latest)
        except Exception as e:  # noqa: BLE001
            failures.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures and rows(spark, path) == {"a0": 0, "a1": 1, "a2": 2} and s.versions(spark, path) == [1, 2, 3]


def test_a_taken_number_is_a_conflict(spark, tmp_path):
    path = str(tmp_path / "t")
    s.upsert(spark, path, frame(spark, a1=1), part(), SCHEMA, latest)
    with pytest.raises(s.Conflict):
        s._commit(spark, path, s.Manifest(1, {}, {}))
    assert rows(spark, path) == {"a1": 1} and not list((tmp_path / "t" / "versions").glob(".*.tmp"))


def test_expired_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        s.upsert(spark, path, frame(spark, a1=i, **{f"b{i}": i}), part(), SCHEMA, latest)
    assert s.expire(spark, path, keep=2) == 2 and s.versions(spark, path) == [3, 4]
    assert rows(spark, path, 3)["a1"] == 2 and rows(spark, path)["a1"] == 3 and len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_odd_part_names(spark, tmp_path):
    path = str(tmp_path / "t")
    s.upsert(spark, path, frame(spark, **{"a/b c=%": 1, "": 2}), F.col("k"), SCHEMA, latest)
    assert rows(spark, path) == {"a/b c=%": 1, "": 2}
