"""Exact top-k search (operator 13) by Fagin's threshold algorithm.

Vectors become whole numbers, floor(scale * x). A task takes its candidates in blocks; each block has one sorted list per dimension. For a
query, the lists are read from the end that its component favours, some entries at a time; each vector met for the
first time is scored in full (random access). What no list has shown yet scores at most the sum of the query's components times the
lists' next values, and once that bound is below the k-th best score so far, which carries over from block to block, the rest of the block
cannot matter. Equal scores do not stop the search, as ties go to smaller ids. Tasks hand on ``k`` rows a query.

Queries are broadcast in groups of about ``GROUP`` bytes, each group with one pass over the candidates; nothing else leaves the
tasks. Sums are exact: doubles while no score can reach 2**53, Python's integers otherwise.

Defined cases: a vector that is null or holds null or non-finite components takes no part; vectors are compared with those of
their own length only (an empty vector scores 0 with other empty ones); of equal scores the smaller id comes first, null ids last; a repeated row is a
candidate and a query of its own (a query leaves out its own row only); an empty table gives an empty table; a score beyond 64 bits is
an error; there are no texts; only the named columns are read, so others may have any name. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, best_rows, col, stored

#: Candidates that share sorted lists, bytes of queries that are broadcast at once, entries of each list read first.
BLOCK, GROUP, DEPTH = 4096, 16 << 20, 16
NONE = np.iinfo("i8").max


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): doubles, which hold these numbers exactly."""
    return np.floor(scale * x.astype("f8"))


class Lists:
    """Candidates of one length with a sorted list for each dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, none: np.ndarray, x: np.ndarray) -> None:
        by = np.argsort(rows)
        self.rows, self.ids, self.none, self.x = rows[by], ids[by], none[by], x[by]
        n, d = x.shape
        self.up = np.ascontiguousarray(np.argsort(self.x, axis=0, kind="stable").T)      # d x n, smallest first
        self.down = self.up[:, ::-1]
        depths = [min(n, DEPTH)]
        while depths[-1] < n:
            depths.append(min(n, depths[-1] * 2))
        self.depths = depths
        ends = [t for t in depths if t < n]
        dims = np.arange(d)[:, None]
        self.low = self.x[self.up[:, ends], dims]              # next value of each list at each depth, read upwards
        self.high = self.x[self.down[:, ends], dims]

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """queries x depths: the most that a vector unseen at that depth can score; nothing is unseen at the last."""
        return np.maximum(q, 0) @ self.high + np.minimum(q, 0) @ self.low


def search_block(lists: Lists, q: np.ndarray, bounds: np.ndarray, own: int, best: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, depth) of the block's vectors that may be among the ``k`` best of a query, ``best`` being its best scores so far."""
    n = len(lists.rows)
    favoured, rest = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    if not len(favoured) and not len(rest):
        favoured = np.arange(min(1, len(q)))                   # all scores are 0: any list will do
    seen = np.zeros(n, bool)
    if own >= 0:
        seen[own] = True
    places, scores = np.zeros(0, "i8"), q[:0]
    done = 0
    for i, t in enumerate(lists.depths):
        fresh = np.zeros(n, bool)
        fresh[lists.down[favoured, done:t]] = True
        fresh[lists.up[rest, done:t]] = True
        if not len(q):
            fresh[:] = True
        fresh &= ~seen
        seen |= fresh
        new = np.flatnonzero(fresh)
        places, scores = np.concatenate([places, new]), np.concatenate([scores, lists.x[new] @ q])
        both = np.concatenate([best, scores])
        if len(both) >= k:
            least = np.partition(both, len(both) - k)[len(both) - k]
            keep = scores >= least
            places, scores = places[keep], scores[keep]
            if i < bounds.shape[0] and bounds[i] < least:
                return places, scores, t
        done = t
    return places, scores, n


class Found:
    """The best candidates of each query so far."""

    def __init__(self, rows: np.ndarray, q: np.ndarray, k: int) -> None:
        self.rows, self.q, self.k = rows, q, k
        self.best: list[tuple[np.ndarray, ...]] = [(q[i, :0], np.zeros(0, "?"), np.zeros(0, "i8"), np.zeros(0, "i8")) for i in range(len(rows))]

    def add(self, rows: np.ndarray, ids: np.ndarray, none: np.ndarray, x: np.ndarray) -> None:
        if self.q.dtype != object and x.dtype != object:
            most = float(np.abs(self.q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
            q = self.q if most < 2.0 ** 53 else None
        else:
            q = None
        if q is None:
            q, x = _python_ints(self.q), _python_ints(x)
        lists = Lists(rows, ids, none, x)
        bounds = lists.bounds(q)
        at = np.minimum(np.searchsorted(lists.rows, self.rows), len(lists.rows) - 1)
        own = np.where(lists.rows[at] == self.rows, at, -1)
        for i in range(len(self.rows)):
            score, *_ = self.best[i]
            places, scores, _ = search_block(lists, q[i], bounds[i], own[i], score, self.k)
            if not len(places):
                continue
            old = self.best[i]
            if object in (old[0].dtype, scores.dtype):
                score = np.concatenate([_python_ints(old[0][None])[0], _python_ints(scores[None])[0]])
            else:
                score = np.concatenate([old[0], scores])
            none_, id_ = np.concatenate([old[1], lists.none[places]]), np.concatenate([old[2], lists.ids[places]])
            row = np.concatenate([old[3], lists.rows[places]])
            by = np.lexsort((row, id_, none_, -score))[:self.k] if score.dtype != object else np.array(
                sorted(range(len(score)), key=lambda j: (-score[j], none_[j], id_[j], row[j]))[:self.k])
            self.best[i] = score[by], none_[by], id_[by], row[by]


def _python_ints(x: np.ndarray) -> np.ndarray:
    if x.dtype == object:
        return x
    out = np.empty(x.shape, object)
    out[...] = [[int(v) for v in r] for r in x] if x.size else out
    return out


def matrices(table: pa.RecordBatch | pa.Table, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, ids, null ids, whole vectors) of each length in (row, id, vec)."""
    vec = table.column("vec")
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    row = table.column("row").to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column("row").to_numpy()
    ids = table.column("id")
    none = np.asarray(ids.is_null())
    ids = np.asarray(ids.fill_null(NONE)).astype("i8")
    start = vec.offsets.to_numpy()
    flat = vec.values.to_numpy(zero_copy_only=False)
    size = np.diff(start)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        x = flat[start[at][:, None] + np.arange(d)[None, :]]
        yield row[at], ids[at], none[at], whole(x, scale)


def usable(vec: Column) -> Column:
    """Not null, and no component that is null, NaN or infinite."""
    size = F.lit(float("inf"))
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < size))


def search(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0,
           is_query: Column | None = None, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (a condition on the column ``id``; none: all rows), the ``k`` other rows with
    the greatest inner products."""
    spark = vectors.sparkSession
    rows = vectors.select(col(vectors, id_col).cast("long").alias("id"), col(vectors, vec_col).cast("array<double>").alias("vec"))
    rows = stored(rows.where(usable(F.col("vec"))).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = rows.where(is_query) if is_query is not None else rows
    bytes_ = asked.agg(F.sum(F.size("vec") * 8 + 16)).first()[0] or 0
    n = bytes_ // group + 1
    found = []
    for g in range(n):
        few = asked if n == 1 else asked.where(F.pmod(F.xxhash64("row"), F.lit(n)) == g)
        ask = list(matrices(few.toArrow(), scale))       # about ``group`` bytes
        names = {int(r): int(i) for row, ids, _, _ in ask for r, i in zip(row, ids)}
        if not names:
            continue
        shared = spark.sparkContext.broadcast([(r, x) for r, _, _, x in ask])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = {x.shape[1]: Found(r, x, k) for r, x in shared.value}
            waiting: dict[int, list] = {d: [] for d in best}

            def flush(d: int, least: int) -> None:
                if sum(len(p[0]) for p in waiting[d]) >= least:
                    whole_ = [np.concatenate(c) for c in zip(*waiting[d])]
                    waiting[d] = []
                    for i in range(0, len(whole_[0]), block):
                        best[d].add(*(c[i:i + block] for c in whole_))

            for b in batches:
                for part in matrices(b, scale) if b.num_rows else ():
                    if (d := part[3].shape[1]) in best:
                        waiting[d].append(part)
                        flush(d, block)
            for d, own in best.items():
                flush(d, 1)
                for q, (score, none, ids, row) in zip(own.rows, own.best):
                    if len(score):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(score), q)), pa.array(ids, mask=none), pa.array(row),
                             pa.array([int(s) for s in score], pa.int64())], ["q", "vec_id", "row", "score"])

        part = arrow_map(rows.select("row", "id", "vec"), run, "q long, vec_id long, row long, score long")
        found.append(part)
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
    best = best_rows(every, ["q"], order, k, "rank", "row")
    named = asked.select(F.col("row").alias("q"), F.col("id").alias("query_id"))
    return best.join(named, "q").select("query_id", "rank", "vec_id", "score")


def op13_topk_search(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, k=5, scale=256.0, is_query=F.col("id") % 50 == 0)


OP13_SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id ASC NULLS LAST) AS rk FROM s)
SELECT query_id, rk::INTEGER AS rank, vec_id, score FROM r WHERE rk <= 5
"""
