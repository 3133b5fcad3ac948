"""Exact inner-product search: longest vectors first, bounded by partial sums in a rotated basis."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageprism.llm.common import map_batches, table
from pageprism.session import stored

K = 5
QUERY_EVERY = 50
SCALE = 256
HEAD = 2048
BLOCK = 2048
QUERY_BLOCK = 256
GROUP_BYTES = 32 << 20
LEADING = (0.25, 0.5)
FEW = 0.05
CROWD = 4
SINGLE = 2.0 ** 24

_PACKED = "least_norm double, greatest_norm double, n int, dim int, ids binary, vectors binary"


def quantised(column: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def usable(column: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return column.isNotNull() & F.coalesce(F.forall(column, finite), F.lit(False))


def _pack_rows(size: int):
    def packed(pieces) -> pa.RecordBatch:
        keys, lengths, values = (np.concatenate(parts) for parts in zip(*pieces))
        dim = int(lengths.max())
        matrix = np.zeros((len(keys), dim))
        matrix[np.arange(dim) < lengths[:, None]] = values
        norms = np.linalg.norm(matrix, axis=1)
        small = np.abs(matrix).max(initial=0) < 2 ** 15
        return pa.RecordBatch.from_pydict({
            "least_norm": [float(norms.min())], "greatest_norm": [float(norms.max())], "n": pa.array([len(keys)], pa.int32()),
            "dim": pa.array([dim], pa.int32()), "ids": [keys.astype("<i8").tobytes()], "vectors": [matrix.astype("<i2" if small else "<f8").tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held = [], 0
        for batch in batches:
            keys, lengths = batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy()
            values, ends = batch.column(1).flatten().to_numpy(), np.append(0, np.cumsum(lengths))
            start = 0
            while start < len(keys):
                stop = min(len(keys), start + size - held)
                pieces.append((keys[start:stop], lengths[start:stop], values[ends[start]:ends[stop]]))
                held += stop - start
                start = stop
                if held == size:
                    yield packed(pieces)
                    pieces, held = [], 0
        if pieces:
            yield packed(pieces)
    return run


def _matrix(ids: bytes, vectors: bytes, dim: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block; components have two bytes where all of the block fit, eight otherwise."""
    keys = np.frombuffer(ids, "<i8")
    own = np.frombuffer(vectors, "<i2" if len(vectors) == 2 * len(keys) * dim else "<f8").reshape(len(keys), dim)
    return keys, np.hstack([own, np.zeros((len(keys), width - dim))]) if dim < width else own.astype(float)


def longest_of(blocks: DataFrame, width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components of the ``size`` longest vectors. The driver gets the lengths and ids of ``size`` blocks at most, and then only the
    blocks that these vectors are in: fewer than ``size`` rows and a block, however many partitions there are."""
    sizes = blocks.select("greatest_norm", "n", "block").orderBy(F.desc("greatest_norm"), "block").limit(size).collect()
    ends = np.cumsum([r.n for r in sizes])
    chosen = [r.block for r, end in zip(sizes, ends) if end - r.n < size]
    parts = [(np.zeros(0, np.int64), np.zeros((0, width)))]
    parts += [_matrix(r.ids, r.vectors, r.dim, width) for r in blocks.where(F.col("block").isin(chosen)).select("ids", "vectors", "dim").collect()]
    ids, vectors = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((ids, -np.linalg.norm(vectors, axis=1)))[:size]
    return ids[order], vectors[order]


def gram_basis(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first, from the matrix of their second moments: executors sum outer products, and
    ``width`` squared numbers per partition meet. An approximate basis would be as exact, only slower."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for ids, vectors, dim in zip(*(batch.column(i).to_pylist() for i in range(3))):
                m = _matrix(ids, vectors, dim, width)[1]
                total += m.T @ m
        i, j = np.indices((width, width)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], names=["i", "j", "m"])

    sums = map_batches(rows.select("ids", "vectors", "dim"), run, "i long, j long, m double")
    moments = np.zeros((width, width))
    for r in sums.groupBy("i", "j").agg(F.sum("m").alias("m")).collect():
        moments[r.i, r.j] = r.m
    values, vectors = np.linalg.eigh(moments)
    return vectors[:, np.argsort(-values)]


class Rotated:
    """Vectors, their norms, and ``bounds``: per cut the leading dimensions of their rotation, and as one more the norm of what is behind them.
    The product of two such rows is a partial sum plus the Cauchy-Schwarz bound of the rest."""

    def __init__(self, matrix: np.ndarray, basis: np.ndarray):
        self.exact = matrix
        self.norms = np.linalg.norm(matrix, axis=1)
        turned, width = matrix @ basis, matrix.shape[1]
        squares = np.cumsum(turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        cuts = sorted({max(1, min(width, int(width * f))) for f in LEADING}) if width else []
        self.bounds = [np.column_stack([turned[:, :c], np.sqrt(squares[:, c]) if c < width else np.zeros(len(matrix))]) for c in cuts]
        self._single = None

    def sides(self, single: bool) -> tuple[np.ndarray, list[np.ndarray]]:
        """Vectors and bounds in double or, made when first asked for, single precision."""
        if not single:
            return self.exact, self.bounds
        if self._single is None:
            self._single = self.exact.astype(np.float32), [b.astype(np.float32) for b in self.bounds]
        return self._single


def _leading(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The ``k`` best per row, best first, and the place of each in its row; ties to the smaller id."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    top = place < k
    return rows[top], ids[top], scores[top], place[top]


def best_rows(queries: Rotated, query_ids: np.ndarray, items: Rotated, item_ids: np.ndarray, k: int, floor: np.ndarray):
    """Arrays of the ``k`` best (query row, id, score, place) per query among ``items``, which come longest first; pairs whose bound lies below
    ``floor`` are pruned. Bounds have a little slack for rounding; scores are sums of integers below 2^53, or 2^24 in single
    precision, hence exact."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    q_most, i_most, width = queries.norms.max(initial=0), items.norms.max(initial=0), queries.exact.shape[1]
    single = q_most * i_most < SINGLE and max(q_most, i_most) < SINGLE
    slack = q_most * i_most * (2 * width + 16) * 2.0 ** -23 + 1e-9 if single else 1e-9 * (q_most * i_most + 1)
    needed = np.where(queries.norms > 0, (floor - slack) / np.maximum(queries.norms, 1e-300), np.where(floor <= 0, -np.inf, np.inf))
    reach = np.searchsorted(-items.norms, -needed.min(initial=np.inf), "right")  # beyond it all items are too short
    if not reach or not len(query_ids):
        return none
    (q, q_bounds), (x, x_bounds) = queries.sides(single), items.sides(single)
    with np.errstate(over="ignore"):  # a floor beyond single precision is above all scores
        least, exact_floor = ((f.astype(q.dtype))[:, None] for f in (floor - slack, floor))
    alive, few = np.ones((len(query_ids), reach), bool), False
    for a, b in zip(q_bounds, x_bounds):
        alive &= a @ b[:reach].T >= least
        if few := np.count_nonzero(alive) < FEW * alive.size:
            break
    if few:
        rows, columns = np.divmod(np.flatnonzero(alive), reach)
        scores = np.einsum("ij,ij->i", q[rows], x[columns])
    else:
        dense = q @ x[:reach].T
        alive &= dense >= exact_floor
        if np.count_nonzero(alive) > CROWD * k * len(query_ids) and reach > k:  # what is below the k-th best need not be sorted
            others = np.where(alive & (query_ids[:, None] != item_ids[None, :reach]), dense, -np.inf)
            alive &= dense >= np.partition(others, reach - k, axis=1)[:, reach - k, None]
        rows, columns = np.divmod(np.flatnonzero(alive), reach)
        scores = dense[rows, columns]
    ids, scores = item_ids[columns], scores.astype(float)
    kept = (scores >= floor[rows]) & (ids != query_ids[rows])
    return _leading(rows[kept], ids[kept], scores[kept], k)


def best_of(queries: Rotated, query_ids: np.ndarray, items: Rotated, item_ids: np.ndarray, k: int, floor: np.ndarray):
    """The (query row, id, score) of ``best_rows`` one by one."""
    rows, ids, scores, _ = best_rows(queries, query_ids, items, item_ids, k, floor)
    yield from zip(rows.tolist(), ids.tolist(), scores.tolist())


def _floors(k: int, width: int, basis, head):
    """Blocks of queries with each query's k-th best score among the longest vectors (minus infinity if there are fewer)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, items = head.value
        longest = Rotated(items, basis.value)
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1)
                ids, queries = _matrix(*(c[0].as_py() for c in block.columns), width)
                floor = np.full(len(ids), -np.inf)
                rows, _, scores, place = best_rows(Rotated(queries, basis.value), ids, longest, item_ids, k, floor)
                floor[rows[place == k - 1]] = scores[place == k - 1]
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array([floor.astype("<f8").tobytes()], pa.binary())],
                                                 names=["ids", "vectors", "dim", "floor"])
    return run


class _Asked:
    """A block of queries and their best items so far; a k-th best score is the floor of what follows."""

    def __init__(self, ids: np.ndarray, queries: Rotated, floor: np.ndarray, k: int):
        self.ids, self.queries, self.floor, self.k = ids, queries, floor.copy(), k
        self.found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def meet(self, items: Rotated, item_ids: np.ndarray) -> None:
        new = best_rows(self.queries, self.ids, items, item_ids, self.k, self.floor)[:3]
        if len(new[0]):
            *self.found, place = _leading(*map(np.concatenate, zip(self.found, new)), self.k)
            rows, _, scores = self.found
            self.floor[rows[place == self.k - 1]] = scores[place == self.k - 1]

    def batch(self) -> pa.RecordBatch:
        rows, ids, scores = self.found
        return pa.RecordBatch.from_arrays([pa.array(self.ids[rows], pa.int64()), pa.array(ids, pa.int64()), pa.array([int(s) for s in scores.tolist()], pa.int64())],
                                          names=["query_id", "vec_id", "score"])


def _pairs(k: int, width: int, basis):
    """Within a cell each block of items, read once, meets all blocks of queries, which come first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}
                if row["cell"] != cell:
                    yield from (a.batch() for a in asked)
                    cell, asked = row["cell"], []
                ids, vectors = _matrix(row["ids"], row["vectors"], row["dim"], width)
                if not row["is_item"]:
                    asked.append(_Asked(ids, Rotated(vectors, basis.value), np.frombuffer(row["floor"], "<f8"), k))
                    continue
                order = np.lexsort((ids, -np.linalg.norm(vectors, axis=1)))
                items = Rotated(vectors[order], basis.value)
                for a in asked:
                    a.meet(items, ids[order])
        yield from (a.batch() for a in asked)
    return run


def _dealt(number: Column, n: int) -> Column:
    """One of ``n`` numbers for a block; the blocks of a partition get one after another, beginning at the partition's own."""
    return F.pmod(F.shiftright(number, 33) + number.bitwiseAND(F.lit((1 << 33) - 1)), F.lit(n)).cast("int")


def search(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """The ``k`` highest integer inner products of each query row with all other rows: query_id, rank, vec_id, score; ties to the smaller id.

    ``vectors`` has vec_id and embedding. Rows are sorted by length into blocks. The longest ``HEAD`` vectors give each query
    a floor, its k-th best score among them. Then every block meets every block of queries: too short rows are skipped by the product of
    lengths, others by partial sums in the rotated basis plus the Cauchy-Schwarz bound of the rest; what is left is multiplied
    out in integers. Blocks of items are dealt to stripes, blocks of queries to groups of about ``GROUP_BYTES``, and each cell of a
    stripe and a group is a partition that holds its queries and reads its items once. Neither side is broadcast or gathered: the
    driver gets the blocks of the longest vectors and the sums of second moments, whatever the number of rows or partitions.

    Vectors null or holding a null or non-finite component take no part, nor do rows without id. Shorter vectors count as filled
    up with zeros. Repeated ids are candidates of their own, except against queries of that id; equal rows of a query are one
    query, and different vectors under one query id share its ``k`` ranks. Extra columns are left out.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding"), is_query.alias("is_query")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = stored(kept.select("vec_id", quantised(F.col("embedding"), scale).alias("v"), "is_query").withColumn(
        "norm", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), "vectors")
    width, n = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.count(F.lit(1))).first()
    if not width:
        width = 1
    by_length = rows.repartitionByRange(F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
    blocks = stored(map_batches(by_length.select("vec_id", "v"), _pack_rows(BLOCK), _PACKED).withColumn("block", F.monotonically_increasing_id()), "blocks")
    basis = spark.sparkContext.broadcast(gram_basis(blocks, width))
    head = spark.sparkContext.broadcast(longest_of(blocks, width, HEAD))
    asked = rows.where("is_query").select("vec_id", "v").dropDuplicates().repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    packed = map_batches(asked, _pack_rows(QUERY_BLOCK), _PACKED).select("ids", "vectors", "dim")
    with_floors = map_batches(packed, _floors(k, width, basis, head), "ids binary, vectors binary, dim int, floor binary")
    queries = stored(with_floors.withColumn("block", F.monotonically_increasing_id()), "queries")
    stripes = max(1, min(math.ceil(n / BLOCK), 4 * spark.sparkContext.defaultParallelism))
    groups = max(1, math.ceil(queries.count() / max(1, GROUP_BYTES // (QUERY_BLOCK * width * 8))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    copies = queries.select("*", F.lit(False).alias("is_item"), _dealt(F.col("block"), groups).alias("group"), every(stripes).alias("stripe"))
    items = blocks.select("ids", "vectors", "dim", F.lit(None).cast("binary").alias("floor"), "block", F.lit(True).alias("is_item"),
                          every(groups).alias("group"), _dealt(F.col("block"), stripes).alias("stripe"))
    met = copies.unionByName(items).withColumn("cell", F.col("stripe") * groups + F.col("group"))
    cells = met.repartitionById(stripes * groups, "cell").sortWithinPartitions("cell", "is_item")
    found = map_batches(cells.select("cell", "is_item", "ids", "vectors", "dim", "floor"), _pairs(k, width, basis), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


OP8_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)), 'bool_and')),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % {QUERY_EVERY} = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
