"""SimHash near-dedup (operator 9) by multi-index hashing.

Fingerprints are made in Arrow batches and written once. Copies collapse to one row per fingerprint
before anything is compared. A pair at ``max_bits`` or fewer differing bits agrees up to one bit in at least one of
``(max_bits + 2) // 2`` segments, so every fingerprint is put into a table under each of its segments,
probes those tables with the Hamming ball of radius 1, and verifies complete distances. Only upward flips
are probed: of two values one bit apart, exactly one reaches the other that way.

A table entry with more than ``crowd`` fingerprints is not joined but divided again by the same rule
over the bits outside its segment; what then shares an entry differs in few bits only (16 of 64 for three
bits), so the group has a fixed bound and is compared block by block, handing on a spanning forest instead of pairs.

Defined cases: a null, empty or blank text has the fingerprint 0, linked like any other; a text
shorter than the shingle is hashed whole; null ids are rows like others and never become a component id
unless all ids of it are null; repeated rows share a class; ties go to the smallest id; an empty table
gives an empty table; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, fresh, slices, stored, words_of
from .components import Forest, components, contracted

SEED = 42
SALTS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = SEED) -> int:
    """The 64-bit SimHash of UTF-8 bytes: bit set if it is set in over half of the shingles' hashes."""
    words = words_of(text.lower())        # bytes.lower() folds A-Z alone
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    votes, total = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, total, 1 << 16):   # very long texts in pieces: memory stays bounded
        h = np.array([digest(b" ".join(words[i:i + shingle]), seed) for i in range(at, min(at + (1 << 16), total))], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, salt): fp is the fingerprint as a signed long; salt spreads the rows of hot fingerprints."""
    source = docs.select(col(docs, id_col).alias("id"), F.encode(col(docs, text_col), "UTF-8").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in slices(batches):
            fps = [fingerprint(t or b"", shingle) for t in b.column(1).to_pylist()]
            salt = [(n + i) % SALTS for i in range(len(fps))]
            n += len(fps)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, "u8").view("i8")), pa.array(salt, pa.int32())], ["id", "fp", "salt"])

    schema = source.select("id").schema.add("fp", "long").add("salt", "integer")
    return arrow_map(source, run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments(bits: list[int], n: int) -> list[list[int]]:
    """``bits`` dealt into ``n`` runs, as signed one-bit masks."""
    cut = [len(bits) * i // n for i in range(n + 1)]
    return [[_signed(1 << b) for b in bits[lo:hi]] for lo, hi in zip(cut, cut[1:])]


def _mask(bits: list[int]) -> int:
    return _signed(sum(b & (2**64 - 1) for b in bits))


def _ball(fp: Column, bits: list[int]) -> Column:
    """The segment's value and its upward one-bit flips."""
    value = fp.bitwiseAND(F.lit(_mask(bits)))
    flips = F.filter(F.array(*[F.lit(b) for b in bits]), lambda b: fp.bitwiseAND(b) == 0)
    return F.concat(F.array(value), F.transform(flips, lambda b: value.bitwiseOR(b)))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _linked_groups(max_bits: int, block: int = 1024) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (seg, key, sub, k2, fp) sorted by their first four columns -> spanning links of each group."""

    def group(fps: np.ndarray, forest: Forest) -> None:
        fps = np.unique(fps)
        bits = fps.view("u8")                              # of a negative number, bitwise_count takes the absolute value
        for i in range(0, len(fps), block):
            for j in range(i, len(fps), block):
                near = np.bitwise_count(bits[i:i + block, None] ^ bits[None, j:j + block]) <= max_bits
                for x, y in zip(*np.nonzero(near)):
                    if i + x < j + y:
                        forest.join(int(fps[i + x]), int(fps[j + y]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, forest = np.empty((0, 5), "i8"), Forest()
        for b in batches:
            rows = np.concatenate([held, np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])])
            ends = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            for part in np.split(rows, ends)[:-1]:
                group(part[:, 4], forest)
            held = rows[ends[-1] if len(ends) else 0:]
            if len(forest.up) > 500_000:
                u, v = forest.stars()
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
                forest = Forest()
        if len(held):
            group(held[:, 4], forest)
        u, v = forest.stars()
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def links(fps: DataFrame, max_bits: int = 3, crowd: int = 1024) -> DataFrame:
    """(u, v): links that connect what lies within ``max_bits`` of each other, for distinct ``fp`` (long)."""
    n = (max_bits + 2) // 2
    parts = segments(list(range(64)), n)
    fp = F.col("fp")
    rows = fps.select("fp", F.posexplode(F.array(*[_ball(fp, p) for p in parts])).alias("seg", "ball"))
    rows = rows.select("fp", "seg", F.posexplode("ball").alias("flip", "key"))
    homes = rows.where("flip = 0").drop("flip")
    crowded = stored(homes.groupBy("seg", "key").count().where(F.col("count") > crowd).select("seg", "key"), "crowded")
    empty = crowded.isEmpty()
    table = homes.select("seg", "key", F.col("fp").alias("other"))
    if not empty:
        table = table.join(crowded, ["seg", "key"], "left_anti")
    pairs = rows.join(table, ["seg", "key"]).where(
        (F.col("fp") != F.col("other")) & ((F.col("flip") > 0) | (F.col("fp") < F.col("other")))
        & (distance(F.col("fp"), F.col("other")) <= max_bits))
    out = contracted(pairs.select(F.col("fp").alias("u"), F.col("other").alias("v")))
    if empty:
        return out
    inner = rows.drop("flip").join(crowded, ["seg", "key"])
    balls = F.lit(None)
    for s, own in enumerate(parts):
        rest = [b for p in parts if p is not own for b in p]
        subs = [rest[len(rest) * i // n:len(rest) * (i + 1) // n] for i in range(n)]
        balls = F.when(F.col("seg") == s, F.array(*[_ball(fp, p) for p in subs])).otherwise(balls)
    inner = inner.select("seg", "key", "fp", F.posexplode(balls).alias("sub", "ball"))
    inner = inner.select(F.col("seg").cast("long").alias("seg"), "key", F.col("sub").cast("long").alias("sub"),
                         F.explode("ball").alias("k2"), "fp")
    groups = ["seg", "key", "sub", "k2"]
    found = arrow_map(inner.repartition(*groups).sortWithinPartitions(*groups), _linked_groups(max_bits), "u long, v long")
    return out.unionByName(found)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3,
            crowd: int = 1024) -> DataFrame:
    """(id, fp, component_id), one row per row of ``docs``: component_id is the smallest id reachable by links."""
    marks = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    # pre-aggregated by (fp, salt): a fingerprint shared by very many rows is never one group of rows
    per_salt = marks.groupBy("fp", "salt").agg(F.min("id").alias("least"))
    reps = stored(per_salt.groupBy("fp").agg(F.min("least").alias("least")), "classes")
    roots = components(links(reps.select("fp"), max_bits, crowd))
    rooted = reps.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    wide = marks.select("fp", "salt").distinct().join(named, "fp")
    return marks.join(wide, ["fp", "salt"]).select("id", "fp", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One document of each class, the one whose id is the component's; the columns of ``docs``.
    Rows that repeat that id all stay; a row without an id cannot be told apart and stays."""
    found = classes(docs, id_col, text_col, **kw)
    first = found.where("id = component_id").select("id").distinct()
    own = col(docs, id_col)
    return docs.join(first, own == first["id"], "left_semi").unionByName(docs.where(own.isNull()))


def single(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each class, the columns of ``docs``: of the rows with the smallest id (null ids last) the first stored.
    Rows are told apart by a number of their own, so repeated rows and rows without ids are documents like others."""
    (rid,) = fresh(docs, "rid")
    rows = stored(docs.withColumn(rid, F.monotonically_increasing_id()), "rows")
    own = col(rows, id_col)
    key = F.struct(own.isNull().alias("none"), own.alias("id"), F.col(rid).alias("rid"))
    found = classes(rows.select(key.alias("key"), col(rows, text_col).alias("text")), "key", "text", **kw)
    first = found.where("id.rid = component_id.rid").select(F.col("id.rid").alias(rid))
    return rows.join(first, rid, "left_semi").select(*[col(rows, c) for c in docs.columns])


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = classes(docs, shingle=3, max_bits=3)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")
