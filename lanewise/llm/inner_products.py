"""Exact top-k inner products over integer vectors, longest vectors first.

Vectors are rotated by the singular vectors of the whole table, so that their first
components carry most of their length. The longest vectors are searched first and give
every query a score to beat; the others follow. A task takes its vectors by descending
length and drops a pair when

* the product of both lengths, or
* the inner product of the leading rotated components plus the product of the lengths of
  the rest (Cauchy-Schwarz)

stays below the query's tenth best score so far. What is left is scored exactly in integers:
in floats or in 64 bits where a bound on the product allows, in Python's integers beyond.

Queries are worked off in blocks of ``BLOCK_QUERIES``, each a pass over the vectors, so a
task holds a block and its own vectors and nothing that grows with the table.

Cases: vectors that are NULL or hold a NULL or non-finite component, and rows without a
vec_id, take no part; vectors of different length are compared as if filled up with
zeros; components of any finite size keep their value, and a score that does not fit a long
counts as the nearest long; equal scores go to the smaller vec_id;
repeated rows are candidates each, and a vec_id asks once, with its smallest vector; no
rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.llm.tables import python_tasks
from lanewise.session import materialize

TOP = 10
SCALE = 1024
WHOLE = float(1 << 53)  # doubles from here on are whole numbers
LONGS = np.iinfo(np.int64)
BLOCK_QUERIES = 4096
LONGEST_SHARE = 1 / 16
LEADING_ENERGY = 0.7
CHUNK_VECTORS, SORTED_VECTORS = 1024, 16_384

_FOUND = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector array<double>, length2) of the vectors that take part; the components
    are whole numbers. A component so large that its multiple is no finite double is one
    that is not finite."""
    usable = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")),
    )

    def floor(x: Column) -> Column:
        return F.when(F.abs(x) < WHOLE, F.floor(x).cast("double")).otherwise(x)

    whole = F.transform("embedding", lambda x: floor(x.cast("double") * scale))
    kept = embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
    return kept.select(F.col("vec_id").cast("bigint"), whole.alias("vector")).withColumn(
        "length2", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    )


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Right singular vectors, strongest first, and how many hold LEADING_ENERGY."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch[0], width)
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["cell", "x"]
        )

    cells = vectors.select("vector").mapInArrow(products, "cell bigint, x double")
    sums = {r.cell: r.x for r in cells.groupBy("cell").agg(F.sum("x").alias("x")).collect()}
    gram = np.array([sums.get(i, 0.0) for i in range(width * width)]).reshape(width, width)
    if not np.isfinite(gram).all():
        return np.eye(width), width
    energy, directions = np.linalg.eigh(gram)
    energy, directions = energy[::-1], directions[:, ::-1]
    share = np.cumsum(energy) / max(energy.sum(), 1e-300)
    return directions, min(width, int(np.searchsorted(share, LEADING_ENERGY)) + 1)


def _lengths(rows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((rows**2).sum(axis=1))


class Block:
    """Queries of one pass, with the scores they have to beat."""

    def __init__(self, ids, vectors, rotation, leading, scores=None):
        self.ids, self.vectors, self.rotation, self.leading = ids, vectors, rotation, leading
        turned = vectors @ rotation
        self.head = turned[:, :leading]
        self.rest = _lengths(turned[:, leading:])
        self.length = _lengths(vectors)
        self.scores = np.full(len(ids), -np.inf) if scores is None else scores


def _best(rows: list[np.ndarray], top: int) -> list[np.ndarray]:
    """(query place, score, vec_id), at most ``top`` for each query, ties to smaller ids."""
    query, score, vec = rows
    order = np.lexsort((vec, -score, query))
    query, score, vec = query[order], score[order], vec[order]
    opens = np.flatnonzero(np.diff(query, prepend=query[:1] - 1))
    sizes = np.diff(np.append(opens, len(query)))
    keep = np.arange(len(query)) - np.repeat(opens, sizes) < top
    return [query[keep], score[keep], vec[keep]]


def _exact(rows: np.ndarray, block: Block, possible: np.ndarray) -> np.ndarray:
    """Integer inner products of the possible pairs; in floats only where those are exact."""
    length, longest = _lengths(rows), block.length.max()
    if length.max() * longest < 2**52:
        return (rows @ block.vectors.T).astype(np.int64)
    small = np.flatnonzero(length * longest < 2**62)
    scores = np.zeros(possible.shape, dtype=np.int64)
    with np.errstate(invalid="ignore"):
        # A component that no long holds meets zeros only, as the product of lengths is small.
        scores[small] = rows[small].astype(np.int64) @ block.vectors.T.astype(np.int64)
    for row in np.flatnonzero(length * longest >= 2**62).tolist():
        own = [int(x) for x in rows[row].tolist()]
        for query in np.flatnonzero(possible[row]).tolist():
            other = block.vectors[query].tolist()
            total = sum([a * int(b) for a, b in zip(own, other, strict=True)])
            scores[row, query] = min(max(total, LONGS.min), LONGS.max)
    return scores


def _search_sorted(
    ids: np.ndarray, rows: np.ndarray, block: Block, best: list[np.ndarray], top: int
) -> list[np.ndarray]:
    """Search vectors given by descending length; raises the block's scores to beat."""
    length = _lengths(rows)
    slack = 1 + 1e-9
    for at in range(0, len(ids), CHUNK_VECTORS):
        part = slice(at, at + CHUNK_VECTORS)
        limit = length[at] * block.length * slack + 1
        if not ((limit >= block.scores) | ~np.isfinite(limit)).any():
            break
        turned = rows[part] @ block.rotation
        rest = _lengths(turned[:, block.leading :])
        ends = length[part][:, None] * block.length
        bound = turned[:, : block.leading] @ block.head.T + rest[:, None] * block.rest
        bound += ends * 1e-9 + 1
        possible = (bound >= block.scores) | ~np.isfinite(bound)
        open_rows = possible.any(axis=1)
        if not open_rows.any():
            continue
        named = ids[part][open_rows]
        possible = possible[open_rows] & (named[:, None] != block.ids)
        scores = _exact(rows[part][open_rows], block, possible)
        possible &= scores >= block.scores
        if len(named) > top:
            worst = np.where(possible, scores, LONGS.min)
            possible &= scores >= np.partition(worst, -top, axis=0)[-top]
        vec, query = np.nonzero(possible)
        new = [query, scores[vec, query], named[vec]]
        best = _best([np.concatenate(x) for x in zip(best, new, strict=True)], top)
        counts = np.bincount(best[0], minlength=len(block.ids))
        full = np.flatnonzero(counts == top)
        lasts = np.cumsum(counts) - 1
        block.scores[full] = np.maximum(block.scores[full], best[1][lasts[full]])
    return best


def _search(vectors: DataFrame, block, width: int, top: int) -> DataFrame:
    """Each task's best vectors for the queries of a broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = block.value
        own = Block(given.ids, given.vectors, given.rotation, given.leading, given.scores.copy())
        best = [np.zeros(0, dtype=np.int64) for _ in range(3)]
        held: list[tuple] = []

        def search(best: list[np.ndarray]) -> list[np.ndarray]:
            ids = np.concatenate([i for i, _ in held])
            rows = np.concatenate([r for _, r in held])
            order = np.argsort(-_lengths(rows), kind="stable")
            return _search_sorted(ids[order], rows[order], own, best, top)

        n = 0
        for batch in batches:
            held.append((batch[0].to_numpy(), _matrix(batch[1], width)))
            n += len(batch[0])
            if n >= SORTED_VECTORS:
                best, held, n = search(best), [], 0
        if n:
            best = search(best)
        query, score, vec = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.ids[query]), pa.array(vec), pa.array(score)],
            names=["query_id", "vec_id", "score"],
        )

    return vectors.select("vec_id", "vector").mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def top_inner_products(vectors: DataFrame, is_query: Column, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` where ``is_query``.

    ``vectors`` come from ``integer_vectors``. A query's own vec_id is no candidate.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    vectors = materialize(vectors, "integer-vectors")
    shape = vectors.agg(
        F.max(F.size("vector")).alias("width"),
        F.percentile_approx("length2", 1 - LONGEST_SHARE).alias("long"),
    ).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if shape.width is None:
        return empty
    width = max(1, shape.width)
    rotation, leading = _rotation(vectors, width)
    longest = vectors.filter(F.col("length2") >= shape.long)
    others = vectors.filter(F.col("length2") < shape.long)
    queries = vectors.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    results = None
    # The iterator fetches one partition of the queries at a time.
    for rows in itertools.batched(queries.toLocalIterator(), BLOCK_QUERIES):
        ids = np.array([r.vec_id for r in rows], dtype=np.int64)
        matrix = _matrix(pa.array([r.vector for r in rows], pa.list_(pa.float64())), width)
        block = Block(ids, matrix, rotation, leading)
        head = materialize(
            _ranked(_search(longest, spark.sparkContext.broadcast(block), width, top), top),
            "longest-found",
        )
        to_beat = {r.query_id: r.score for r in head.filter(F.col("rank") == top).collect()}
        block.scores = np.array([to_beat.get(i, -np.inf) for i in ids.tolist()], dtype=np.float64)
        found = _search(others, spark.sparkContext.broadcast(block), width, top)
        ranked = _ranked(found.unionByName(head.drop("rank")), top)
        done = materialize(ranked.select("query_id", "rank", "vec_id", "score"), "top-found")
        results = done if results is None else results.unionByName(done)
    return empty if results is None else results
