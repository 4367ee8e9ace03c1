"""Embedding near-dedup (operator 2): iterative quantisation, multi-index Hamming tables, exact reranking.

A rotation is learned on a bounded sample so that the signs of the rotated vectors are balanced codes that
quantise well (alternating between codes and the orthogonal Procrustes problem). Every vector gets a code of
64 bits, cut into segments of 16. Two codes within ``RADIUS`` = 11 bits agree up to two bits in at least one of four
segments: each side enters its segment's ball of radius one, so they meet in the middle. A pair is taken at one
meeting point only (the first segment within reach; of two middles the one that flips the lower bit), its codes are compared
in full, and what is left is reranked by the cosine of the original vectors in double precision. Where very many vectors share an
entry, it is cut into tiles and compared block by block, which hands on counts and a spanning forest instead of pairs.

Codes have 64 bits if vectors have 64 dimensions or more (else as many as dimensions, in segments of 16 at most).

Copies (equal components) are one vector for the search and count with their number. Defined cases: vectors that are null,
empty, zero, of another length than the sample's, or hold a null or a non-finite component link with nothing and are their own
component; null ids are searched like others but never name a component that has any other id; repeated rows are
copies; an empty table gives an empty table; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, key128, slices, stored
from .components import Forest, components

#: Rows that the rotation is learned from, at most.
SAMPLE = 20_000
SEGMENT, REACH = 16, 2


def learn(sample: np.ndarray, rounds: int = 50, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): sign((x - mean) @ projection) is the code. ``sample`` holds unit vectors."""
    mean = sample.mean(0)
    x = sample - mean
    _, _, axes = np.linalg.svd(x, full_matrices=False) if len(x) >= x.shape[1] else (0, 0, np.eye(x.shape[1]))
    bits = min(64, x.shape[1])
    v = x @ axes[:bits].T
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):
        codes = np.where(v @ turn >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(codes.T @ v)
        turn = (u @ w).T
    return mean, axes[:bits].T @ turn


def usable(vectors: list, dim: int | None = None) -> np.ndarray:
    """Which vectors can link: all components there and finite, not all zero, of the common length."""
    return np.array([v is not None and len(v) > 0 and (dim is None or len(v) == dim) and None not in v
                     and bool(np.isfinite(np.asarray(v, float)).all()) and any(v) for v in vectors], bool)


def encode(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    unit = scaled(vectors)
    bits = np.zeros((len(unit), 64), bool)
    bits[:, :projection.shape[1]] = (unit - mean) @ projection >= 0
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")[:, 0]


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def codes(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, k1, k2, code): v a unit vector in double precision and (k1, k2) its identity; both null if it cannot link."""
    source = vectors.select(col(vectors, id_col).alias("id"), col(vectors, vec_col).cast("array<double>").alias("v"))
    v = F.col("v")
    fine = ((F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("v", lambda x: x != 0))
    rows = source.withColumn("v", F.when(fine, v))
    # a threshold on the row's hash leaves about SAMPLE rows, so that no task gathers more
    share = min(1.0, SAMPLE / max(1, vectors.count()))
    mark = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40))
    sample = (rows.where(F.col("v").isNotNull() & (mark <= int(share * (1 << 40)))).orderBy(mark).limit(SAMPLE)
              .select("v").toArrow()["v"].to_pylist())
    dim = max((len(x) for x in sample), key=[len(x) for x in sample].count, default=1)
    own = np.array([x for x in sample if len(x) == dim]).reshape(-1, dim)
    mean, projection = learn(scaled(own)) if len(own) else (np.zeros(dim), np.eye(dim)[:, :64])
    shared = vectors.sparkSession.sparkContext.broadcast((dim, mean, projection))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, m, p = shared.value
        for b in slices(batches):
            values = b.column(1).to_pylist()
            good = [i for i, x in enumerate(values) if x is not None and len(x) == n]
            unit: list = [None] * len(values)
            code = np.zeros(len(values), "i8")
            if good:
                x = np.array([values[i] for i in good])
                code[good] = encode(x, m, p)
                for i, y in zip(good, scaled(x)):
                    unit[i] = y
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(unit, pa.list_(pa.float64())), b.column(1), pa.array(code)],
                                             ["id", "v", "raw", "code"])

    id_type = source.schema["id"].dataType.simpleString()
    out = arrow_map(rows, run, f"id {id_type}, v array<double>, raw array<double>, code long")
    k1, k2 = key128(F.col("raw"))
    known = F.col("v").isNotNull()
    return out.select("id", "v", F.when(known, k1).alias("k1"), F.when(known, k2).alias("k2"), "code")


def _segments(code: Column) -> list[Column]:
    return [F.shiftrightunsigned(code, SEGMENT * s).bitwiseAND(F.lit((1 << SEGMENT) - 1)) for s in range(64 // SEGMENT)]


def _meets(a: Column, b: Column, seg: Column, key: Column, radius: int) -> Column:
    """Whether this entry is the one at which the ordered pair of codes is taken."""
    x = a.bitwiseXOR(b)
    apart = [F.bit_count(d) for d in _segments(x)]
    parts = _segments(a)
    ok = F.lit(False)
    for s in range(len(apart)):
        d = parts[s].bitwiseXOR(_segments(b)[s])
        low = d.bitwiseAND(-d)
        middle = F.when(apart[s] == 2, parts[s].bitwiseXOR(low)).otherwise(parts[s].bitwiseOR(_segments(b)[s]))
        here = (apart[s] <= REACH) & (key == middle)
        for earlier in range(s):
            here = here & (apart[earlier] > REACH)
        ok = F.when(seg == s, here).otherwise(ok)
    return (F.bit_count(x) <= radius) & ok


def _entries(distinct: DataFrame) -> DataFrame:
    """(n, code, seg, key): every vector under the ball of radius one of each of its segments."""
    flips = F.array(F.lit(0), *[F.lit(1 << i) for i in range(SEGMENT)])
    rows = distinct.select("n", "code", F.posexplode(F.array(*_segments(F.col("code")))).alias("seg", "value"))
    return rows.select("n", "code", "seg", F.explode(F.transform(flips, lambda f: F.col("value").bitwiseXOR(f))).alias("key"))


def link_pairs(distinct: DataFrame, entries: DataFrame, threshold: float, radius: int) -> DataFrame:
    """(a, b): ordered pairs of distinct vectors that meet in ``entries`` and whose cosine reaches ``threshold``."""
    other = entries.select("seg", "key", F.col("n").alias("b"), F.col("code").alias("code_b"))
    found = entries.join(other, ["seg", "key"]).where(
        (F.col("n") < F.col("b")) & _meets(F.col("code"), F.col("code_b"), F.col("seg"), F.col("key"), radius))
    pairs = found.select(F.col("n").alias("a"), "b")
    left = distinct.select(F.col("n").alias("a"), F.col("v").alias("va"))
    right = distinct.select(F.col("n").alias("b"), F.col("v").alias("vb"))
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").where(dot >= threshold).select("a", "b")


def meeting(a: np.ndarray, b: np.ndarray, seg: int, key: int, radius: int) -> np.ndarray:
    """``_meets`` for all pairs of two arrays of codes (unsigned), those of ``a`` counting as the first."""
    x = a[:, None] ^ b[None, :]
    ok = np.bitwise_count(x) <= radius
    mask = np.uint64((1 << SEGMENT) - 1)
    for s in range(seg):
        ok &= np.bitwise_count((x >> np.uint64(SEGMENT * s)) & mask) > REACH
    shift = np.uint64(SEGMENT * seg)
    d, first = (x >> shift) & mask, np.broadcast_to((a[:, None] >> shift) & mask, x.shape)
    apart = np.bitwise_count(d)
    middle = np.where(apart == 2, first ^ (d & (~d + np.uint64(1))), first | ((b[None, :] >> shift) & mask))
    return ok & (apart <= REACH) & (middle == np.uint64(key))


def _tiles(threshold: float, radius: int):
    """Rows (seg, key, i, j, tile, n, code, copies, v) sorted by their first five columns -> (n, linked, root): the copies linked to n in this
    pair of tiles, and the root of n in a forest of the links; one row per vector and pair of tiles at most."""
    def pair(rows: pa.Table) -> pa.RecordBatch:
        seg, key, i, j = (rows[c][0].as_py() for c in ("seg", "key", "i", "j"))
        tile, n = rows["tile"].to_numpy(), rows["n"].to_numpy()
        code, copies = rows["code"].to_numpy().view("u8"), rows["copies"].to_numpy()
        v = np.array(rows["v"].to_pylist(), float)
        x, y = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        near = v[x] @ v[y].T >= threshold
        near &= np.where(n[x][:, None] < n[y][None, :], meeting(code[x], code[y], seg, key, radius),
                         (n[x][:, None] > n[y][None, :]) & meeting(code[y], code[x], seg, key, radius).T)
        linked, forest = np.zeros(len(n), "i8"), Forest()
        linked[x] += near @ copies[y]
        if i != j:
            linked[y] += near.T @ copies[x]
        for a, b in zip(*np.nonzero(near)):
            forest.join(int(n[x[a]]), int(n[y[b]]))
        some = np.flatnonzero(linked)
        return pa.RecordBatch.from_arrays([pa.array(n[some]), pa.array(linked[some]), pa.array([forest.root(int(k)) for k in n[some]], pa.int64())],
                                          ["n", "linked", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            rows = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            group = np.column_stack([rows[c].to_numpy() for c in ("seg", "key", "i", "j")])
            cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1)]
            for lo, hi in zip(cuts, cuts[1:]):
                yield pair(rows.slice(lo, hi - lo).combine_chunks())
            held = rows.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield pair(held.combine_chunks())
    return run


def crowded_links(distinct: DataFrame, entries: DataFrame, threshold: float, radius: int, tile: int) -> DataFrame:
    """(n, linked, root) of the vectors that meet in crowded entries (with their ``size``): an entry is cut into tiles, every pair of
    tiles is compared as one block, and what comes out are counts and a forest, not pairs."""
    rows = entries.join(distinct.select("n", "copies", "v"), "n").withColumn("tiles", F.ceil(F.col("size") / tile))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("n"), F.col("tiles")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.select(F.col("seg").cast("long").alias("seg"), F.col("key").cast("long").alias("key"), F.least("tile", "other").alias("i"),
                       F.greatest("tile", "other").alias("j"), "tile", "n", "code", "copies", "v")
    group = ["seg", "key", "i", "j"]
    return arrow_map(rows.repartition(*group).sortWithinPartitions(*group, "tile", "n"), _tiles(threshold, radius), "n long, linked long, root long")


def dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
          radius: int = 11, crowd: int = 128, tile: int = 512) -> DataFrame:
    """(id, n_links, component_id), one row per row of ``vectors``. ``radius`` is the Hamming distance up to which codes are
    reranked; up to 11 the tables miss no pair within it. Entries with more than ``crowd`` vectors are compared in blocks of
    ``tile`` by ``tile``."""
    rows = stored(codes(vectors, id_col, vec_col), "vectors")
    searched = rows.where("k1 IS NOT NULL")
    # one row per distinct vector: partial before the shuffle, so copies are no hot group; n is its identity
    distinct = searched.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("id").alias("least"), F.first("v").alias("v"),
                                                F.first("code").alias("code"))
    distinct = stored(distinct.withColumn("n", F.monotonically_increasing_id()), "distinct")
    entries = _entries(distinct)
    full = stored(entries.groupBy("seg", "key").agg(F.count("*").alias("size")).where(F.col("size") > crowd), "crowded")
    thin = entries.join(full.drop("size"), ["seg", "key"], "left_anti")
    pairs = stored(link_pairs(distinct.select("n", "v", "code"), thin, threshold, radius), "links")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(distinct.select(F.col("n").alias("b"), "copies"), "b").select(F.col("a").alias("n"), F.col("copies").alias("linked"))
    links = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not full.isEmpty():
        blocks = stored(crowded_links(distinct, entries.join(full, ["seg", "key"]), threshold, radius, tile), "blocks")
        degree = degree.unionByName(blocks.select("n", "linked"))
        links = links.unionByName(blocks.where("n != root").select(F.col("n").alias("u"), F.col("root").alias("v")))
    degree = degree.groupBy("n").agg(F.sum("linked").alias("linked"))
    roots = components(links).withColumnRenamed("v", "n")
    named = (distinct.select("n", "k1", "k2", "copies", "least").join(degree, "n", "left").join(roots, "n", "left")
             .withColumn("root", F.coalesce("root", "n")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    found = salted_join(searched.select("id", "k1", "k2"), named)
    rest = rows.where("k1 IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.select("id", "n_links", "component_id").unionByName(rest)


def salted_join(rows: DataFrame, named: DataFrame, salts: int = 64) -> DataFrame:
    """``rows`` with what ``named`` says of their (k1, k2); copies in great number are spread by a salt of their id."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    wide = rows.select("k1", "k2", "salt").distinct().join(named, ["k1", "k2"])
    return rows.join(wide, ["k1", "k2", "salt"])


def op2_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = dedup(vectors, threshold=0.95)
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
