"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored

#: Vertices that one task holds before it hands on what it has joined so far.
HELD = 500_000


class Forest:
    """Union-find over integers; the smallest member is the root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (p := up.setdefault(top, top)) != top:
            top = p
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a < b:
            self.up[b] = a
        elif b < a:
            self.up[a] = b

    def stars(self) -> tuple[list[int], list[int]]:
        pairs = [(v, r) for v in list(self.up) if (r := self.root(v)) != v]
        return [v for v, _ in pairs], [r for _, r in pairs]


def _stars(forest: Forest) -> pa.RecordBatch:
    u, v = forest.stars()
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            forest.join(x, y)
        if len(forest.up) > HELD:
            yield _stars(forest)
            forest = Forest()
    yield _stars(forest)


def contracted(edges: DataFrame) -> DataFrame:
    """The links of each partition as stars (u > v): the same components, at most one row a vertex."""
    return arrow_map(edges, _contract, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (two long columns) that is not its component's smallest.

    Each round writes its links to the shared folder and compares their count and checksum with those of
    the round before. Minima are partial before their shuffles, so a vertex with very many links
    is no hot group; the joins with them are many-to-one.
    """
    e = stored(contracted(edges).distinct(), "links")
    seen = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or now[0] == 0:
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
        seen = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                              F.col("m").alias("v")).where("u != v")
        keep = least.select("u", F.col("m").alias("v"))
        # dealt by whole links, not by a vertex: the centre of a large star is no hot group
        e = stored(contracted(small.unionByName(keep).distinct()).distinct(), "links")
