"""Exact search against brute force and its SQL twin."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageprism.llm import topk


def brute(rows, k, is_query):
    good = [(i, np.floor(256 * np.array(v, np.float64))) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, v in good:
        if is_query(i):
            scored = sorted(((-int(np.dot(np.pad(v, (0, max(0, len(w) - len(v)))), np.pad(w, (0, max(0, len(v) - len(w)))))), j) for j, w in good if j != i))
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


def rows_of(df):
    rows = df.collect()
    out = {(r.query_id, r.rank, r.vec_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * rng.choice([0.01, 1, 30])).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] + [1.0] * 5), (303, [float("inf")] * 6), (None, [1.0] * 6), (304, [0.0] * 6),
             (305, [1.0, 2.0]), (310, [9.0] * 6), (311, [9.0] * 6), (312, [9.0] * 6), (320, []), (330, [-5.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, ids string").repartition(4)
    old = topk.HEAD, topk.BLOCK, topk.QUERY_BLOCK
    try:
        topk.HEAD, topk.BLOCK, topk.QUERY_BLOCK = 7, 32, 8
        found = rows_of(topk.search(df, F.col("vec_id") % 5 == 0))
    finally:
        topk.HEAD, topk.BLOCK, topk.QUERY_BLOCK = old
    assert found == brute(rows, 5, lambda i: i % 5 == 0)
    assert topk.search(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    two = df.where("vec_id in (5, 7)")
    assert len(rows_of(topk.search(two, F.col("vec_id") % 5 == 0))) == 1


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert rows_of(topk.op8_topk(spark, sf)) == brute(rows, 5, lambda i: i % 50 == 0)


def test_bounds_prune_long_tails():
    rng = np.random.default_rng(1)
    items = np.floor(rng.normal(size=(3000, 16)) * np.geomspace(200, 2, 3000)[:, None])
    items = items[np.argsort(-np.linalg.norm(items, axis=1))]
    queries = items[:20]
    basis = np.linalg.svd(items, full_matrices=False)[2].T
    scores = queries @ items.T
    scores[np.arange(20), np.arange(20)] = -np.inf
    floor = np.sort(scores[:, :500], axis=1)[:, -5]
    found = list(topk.best_of(topk.Rotated(queries, basis), np.arange(20), topk.Rotated(items, basis), np.arange(3000), 5, floor))
    for q in range(20):
        want = sorted(zip(-scores[q], np.arange(3000)))[:5]
        assert [(i, s) for r, i, s in found if r == q] == [(i, -s) for s, i in want]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_driver_gets_no_side_of_the_search(spark, monkeypatch):
    """Small tables too: a side that Spark takes for small would be gathered with all its copies, and a top of whole vectors comes from each partition."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    collected, classic = [], type(df)
    collect = classic.collect
    monkeypatch.setattr(classic, "collect", lambda self: collected.append((self.columns, plan(self))) or collect(self))
    for name, size in (("HEAD", 7), ("BLOCK", 32), ("QUERY_BLOCK", 8)):
        monkeypatch.setattr(topk, name, size)
    found = topk.search(df, F.col("vec_id") % 5 == 0)
    assert "Broadcast" not in plan(found) and "CartesianProduct" not in plan(found)
    tops = [columns for columns, p in collected if "TakeOrderedAndProject" in p]
    assert tops and not any({"v", "vectors"} & set(columns) for columns in tops)
    assert rows_of(found) == brute(rows, 5, lambda i: i % 5 == 0)


@pytest.mark.parametrize("scale", [1, 5000])
def test_many_cells(spark, monkeypatch, scale):
    """Groups of one block each; repeated ids, ties and equal vectors over all of them; both precisions."""
    rng = np.random.default_rng(8)
    rows = [(i % 250, (scale * rng.integers(-2, 3, size=5) / 256).tolist()) for i in range(400)]
    rows += [(5 * i, [scale / 256] * 5) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for name, size in (("HEAD", 9), ("BLOCK", 64), ("QUERY_BLOCK", 8), ("GROUP_BYTES", 1)):
        monkeypatch.setattr(topk, name, size)
    got = rows_of(topk.search(df, F.col("vec_id") % 25 == 0))
    good = [(i, np.floor(256 * np.array(v))) for i, v in rows]
    for q in {i for i, _ in good if i % 25 == 0}:
        asked = {tuple(v) for i, v in good if i == q}
        want = sorted((-int(np.dot(v, w)), j) for v in asked for j, w in good if j != q)[:5]
        assert sorted((rank, i, s) for query, rank, i, s in got if query == q) == [(n + 1, j, -s) for n, (s, j) in enumerate(want)]


def test_longest_of_many_blocks(spark):
    rng = np.random.default_rng(9)
    rows = [(i, float(rng.integers(0, 40))) for i in range(200)]
    df = spark.createDataFrame([(i, [x, 0.0]) for i, x in rows], "vec_id long, v array<double>").withColumn("norm", F.col("v")[0])
    by_length = df.repartitionByRange(6, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
    blocks = topk.map_batches(by_length.select("vec_id", "v"), topk._pack_rows(7), topk._PACKED).withColumn("block", F.monotonically_increasing_id())
    for size in (1, 20, 200, 300):
        ids, vectors = topk.longest_of(blocks, 3, size)
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:size]
        assert vectors.shape == (len(want), 3) and [(i, x) for i, (x, _, _) in zip(ids.tolist(), vectors.tolist())] == want
    ids, vectors = topk.longest_of(blocks.limit(0), 3, 5)
    assert len(ids) == 0 and vectors.shape == (0, 3)


def test_blocks_keep_components_that_two_bytes_cannot():
    import pyarrow as pa

    vectors = [[1.0, -32767.0], [], [32768.0], [1e100, 2.0, -3.0]]
    batch = pa.RecordBatch.from_arrays([pa.array([3, -1, 4, 9]), pa.array(vectors, pa.list_(pa.float64()))], names=["vec_id", "v"])
    got = []
    for block in topk._pack_rows(2)(iter([batch.slice(0, 1), batch.slice(1, 3)])):
        for row in block.to_pylist():
            ids, matrix = topk._matrix(row["ids"], row["vectors"], row["dim"], 4)
            got += zip(ids.tolist(), matrix.tolist())
    assert got == [(i, v + [0.0] * (4 - len(v))) for i, v in zip([3, -1, 4, 9], vectors)]
