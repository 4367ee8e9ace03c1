r"""Target-distribution importance resampling (operator 12).

Words and runs of up to three words are hashed to buckets (CRC-32); how much likelier a bucket is in the target than in
the documents is its gain, and all gains are one small array. A document's weight is the sum of that array over its features,
taken in numpy a text at a time; with noise that depends on the id alone added, the highest scores are a draw without
replacement in proportion to the weights.

The draw is a distributed quickselect. Scores are written once. Each round picks some rows between the bounds at random as
pivots, counts in one scan how many rows lie before, at and after each pivot, and moves the bounds to the
two pivots around the k-th row, until the k-th row is a pivot. Keys are (score, id, row), so they are all different and a
score that a third of the rows share is no obstacle. Only the winners are then sorted (range exchange) and ranked.

Defined cases: a null or empty text has no features, weight 0, and is drawn only if ``min_words`` is 0; very long texts are
read whole in pieces; ties go to the smaller id, null ids last (their noise is that of the empty id); repeated rows are
documents of their own, in no particular order among themselves; an empty table gives an empty table; without target texts every
bucket's t is 0; only the named columns are read, so others may have any name, and ``drawn`` returns them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, fresh, n_partitions, slices, stored, term_pieces

#: Pivots that a round of the selection picks, about.
PIVOTS = 24


def feature_hashes(text: bytes | None) -> Iterator[tuple[int, np.ndarray]]:
    """For each piece of a text (UTF-8): its words, and the CRC-32 of all runs of 1 to 3 words that end in it."""
    before: list[bytes] = []
    for piece in term_pieces(text or b""):
        words = piece.split()
        if not words:
            continue
        run, old = before + words, len(before)
        spaced = [b" " + w for w in run]
        one = list(map(crc32, run))
        two = list(map(crc32, spaced[1:], one))        # the checksum goes on where the shorter run's ends
        three = list(map(crc32, spaced[2:], two))
        yield len(words), np.array(one[old:] + two[max(old - 1, 0):] + three, "u4")
        before = run[-2:]


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts (one binary column) in each bucket; the driver gets one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, "i8")
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                for _, h in feature_hashes(t):
                    n += np.bincount(h % buckets, minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    out = np.zeros(buckets, "i8")
    for r in arrow_map(texts, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each of B buckets."""
    s_all, t_all, b = float(own.sum()), float(target.sum()), len(own)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + b) / ((float(s) + 1) * (t_all + b)))) for s, t in zip(own, target)], "i8")


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    source = docs.select(col(docs, id_col).alias("id"), F.encode(col(docs, text_col), "UTF-8").alias("t"))
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words, features, weight = [], [], []
            for t in b.column(1).to_pylist():
                w = f = g = 0
                for n, h in feature_hashes(t):
                    w, f, g = w + n, f + len(h), g + int(gain[h % buckets].sum())
                words.append(w)
                features.append(f)
                weight.append(g)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (words, features, weight))],
                                             ["id", "n_words", "n_features", "weight"])

    schema = source.select("id").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    return arrow_map(source, run, schema)


def noise(id_: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))), u from the first 8 hex digits of sha256("seed:id")."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.ln(-F.ln(u))).cast("long")


# ---- selection ----

def _key(score: Column, id_: Column, row: Column) -> Column:
    """Orders rows by score (highest first), id (null last) and row."""
    return F.struct((-score).alias("s"), id_.isNull().alias("none"), id_.alias("id"), row.alias("row"))


def _literal(key, id_type) -> Column:
    return F.struct(F.lit(key.s).cast("long").alias("s"), F.lit(key.none).alias("none"), F.lit(key.id).cast(id_type).alias("id"),
                    F.lit(key.row).cast("long").alias("row"))


def kth(rows: DataFrame, k: int, n: int, pivots: int = PIVOTS):
    """The key of the k-th of ``n`` rows (score, id, row); ``rows`` is scanned twice a round, the driver gets the pivots and their counts."""
    id_type = rows.schema["id"].dataType
    key = F.col("key")
    keyed = rows.select(_key(F.col("score"), F.col("id"), F.col("row")).alias("key"))
    lower = upper = None
    left, before, turn = n, 0, 0                   # rows between the bounds, rows up to the lower bound
    while True:
        turn += 1
        between = keyed if lower is None else keyed.where(key > _literal(lower, id_type))
        between = between if upper is None else between.where(key < _literal(upper, id_type))
        # each row with the same chance, so that about ``pivots`` are picked
        chance = int(min(1.0, pivots / left) * (1 << 40))
        picked = between.where(F.pmod(F.xxhash64("key.row", F.lit(turn)), F.lit(1 << 40)) < F.lit(chance)).limit(8 * pivots)
        found = [r.key for r in picked.collect()]
        found.sort(key=lambda x: (x.s, x.none, 0 if x.none else x.id, x.row))
        if not found:
            continue
        # 2j: after j pivots and at none of them; 2j + 1: at the pivot that follows j others
        marks = rows.sparkSession.createDataFrame([(x,) for x in found], keyed.schema).agg(F.sort_array(F.collect_list("key"))).scalar()
        slot = 2 * F.size(F.filter("marks", lambda x: x < key)) + F.array_contains("marks", key).cast("int")
        sizes = {r.slot: r.n for r in between.withColumn("marks", marks).groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect()}
        at = 0
        while k - before > sizes.get(at, 0):
            before += sizes.get(at, 0)
            at += 1
        if at % 2:
            return found[at // 2]
        left = sizes[at]
        lower = found[at // 2 - 1] if at else lower
        upper = found[at // 2] if at // 2 < len(found) else upper


def numbered(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``rows`` with their place (from 1) in ``order``: sorted by range, then each partition starts after those before it."""
    spark = rows.sparkSession
    (at,) = fresh(rows, "at")
    # partition number and place in the partition are the high and the low bits of this id
    placed = stored(rows.repartitionByRange(n_partitions(spark), *order).sortWithinPartitions(*order)
                    .withColumn(at, F.monotonically_increasing_id()), "winners")
    part, place = F.shiftright(F.col(at), 33), F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("p")).agg(F.max(place).alias("last")).orderBy("p").collect()    # one a partition
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r.p, total))
        total += r["last"] + 1
    starts = spark.createDataFrame(offsets, "p long, start long")
    out = placed.join(F.broadcast(starts), part == F.col("p"))
    return out.withColumn(rank, F.col("start") + place + 1).drop("p", "start", at)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = 5, min_words: int = 20, buckets: int = 10_000, seed: int = 42, pivots: int = PIVOTS) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank): a row for each row of ``docs``; rank is null where it was not drawn."""
    own = bucket_counts(docs.select(F.encode(col(docs, text_col), "UTF-8").alias("t")), buckets)
    wanted = bucket_counts(target.select(F.encode(col(target, target_text), "UTF-8").alias("t")), buckets)
    scored = weighed(docs, gains(own, wanted), id_col, text_col)
    scored = stored(scored.select("*", (F.col("weight") + noise(F.col("id"), seed)).alias("score"), F.monotonically_increasing_id().alias("row")), "scores")
    fit = scored.where(F.col("n_words") >= min_words)
    n = fit.count()
    k = percent * n // 100
    names = ["id", "n_words", "n_features", "weight", "score"]
    if not k:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    last = _literal(kth(fit.select("score", "id", "row"), k, n, pivots), scored.schema["id"].dataType)
    wins = (F.col("n_words") >= min_words) & (_key(F.col("score"), F.col("id"), F.col("row")) <= last)
    drawn = numbered(scored.where(wins), [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")], "rank")
    rest = scored.where(~wins).select(*names, F.lit(None).cast("long").alias("rank"))
    return rest.unionByName(drawn.select(*names, "rank"))


def drawn(docs: DataFrame, ranks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that ``resample`` drew, with their own columns; ids must be different and not null."""
    own = col(docs, id_col)
    won = ranks.where("rank IS NOT NULL").select(F.col("id").alias("__won"))
    return docs.join(won, own == F.col("__won"), "left_semi")


def op12_importance(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"), percent=5, min_words=20)
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: DuckDB has no CRC-32: its table follows from the polynomial, and a feature's bytes are folded over it.
OP12_SQL = r"""
WITH RECURSIVE step AS (SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS MATERIALIZED (SELECT regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
df AS MATERIALIZED (SELECT rid, f, count(*)::BIGINT AS n FROM (
  SELECT rid, unnest(ws) AS f FROM d
  UNION ALL SELECT rid, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM d WHERE len(ws) > 1
  UNION ALL SELECT rid, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM d WHERE len(ws) > 2) GROUP BY ALL),
bf AS MATERIALIZED (SELECT f, count(*)::BIGINT AS n FROM (
  SELECT unnest(ws) AS f FROM b
  UNION ALL SELECT unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM b WHERE len(ws) > 1
  UNION ALL SELECT unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM b WHERE len(ws) > 2) GROUP BY ALL),
fs AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
fb AS MATERIALIZED (SELECT f, (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2),
  lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)), lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 10000) AS bucket FROM fs, crc),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM df JOIN fb USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM bf JOIN fb USING (f) GROUP BY bucket),
alls AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS sa, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS ta),
gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (sa + 10000) / ((s::DOUBLE + 1) * (ta + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket), alls),
w AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM df JOIN fb USING (f) JOIN gain USING (bucket) GROUP BY rid),
sc AS MATERIALIZED (SELECT d.rid, doc_id, len(ws) AS nw, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN w USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST, rid) AS rk, count(*) OVER () AS n FROM sc WHERE nw >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rk <= (5 * n) // 100 THEN rk END::BIGINT AS rank FROM sc LEFT JOIN r USING (rid)
"""
