"""LM scoring (operator 5) with a log-frequency Bloom filter of n-gram counts.

Every pair's count is quantised to ``1 + floor(log_B(count))``; the filter holds the pair together with each level
up to its own, and a count is read back by probing level after level until one is missing. All pairs of all words are held,
those found once too, told apart by the 64-bit hashes of both words. The filter is a table of shards that is never gathered: the number
of shards follows the text, and each has ``BITS_PER_ENTRY`` bits or more for each of its entries, so the rate of false
positives does not rise with the input. A piece of text sends its distinct pairs and words to their shards, which answer with
levels, and with the words' exact counts and numbers of different followers.

The probability of a token after the one before it is Witten-Bell smoothed: pair counts come from the filter, word counts and
followers from the exact table. A text begins and ends with the end token, which is counted as a token. The unigram
score of the contract uses the same exact counts. A word or pair is one entry of a row for each piece of text that has it, so none is hot.

Defined cases: a null, empty or blank text is the end token alone; a null id counts as the empty string when
folds are dealt and stays null; repeated rows are learned from as often as they occur and get equal scores;
an empty training set gives every token the probability 1; an empty table gives
an empty table; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, discard, n_partitions, release, slices, stored, words_of

#: Pairs of numbered words, as ``build_filter`` takes them: first << TOP_BITS | second.
TOP_BITS = 18
TOP = 1 << TOP_BITS
#: Base of the quantisation, probes per entry, and bits per entry.
BASE, PROBES, BITS_PER_ENTRY = 1.5, 4, 12
#: Shards at least, and bytes of text for each: what a task holds at once is one shard.
SHARDS, SHARD_TEXT = 1 << 8, 24 << 20
#: Tokens that a task turns into pairs at once, and bytes of text that it turns into tokens at once.
CHUNK, PIECE = 1 << 21, 2 << 20
END = b""


def digest(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


END_HASH = digest(END)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first.astype("u8") + np.uint64(0x9E3779B97F4A7C15)) + second.astype("u8"))


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_B(count)), and 0 for 0."""
    return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9), 0).astype("i8")


def expected(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level."""
    low = np.ceil(BASE ** (level - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(BASE ** level.astype(float) - 1e-9) - 1)
    return np.where(level > 0, (low + high) / 2, 0.0)


def _hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """What the probes of (key, level) start from and step by."""
    h = mix(keys + np.uint64(0xD1B54A32D192ED03 * level & 0xFFFFFFFFFFFFFFFF))
    return h, (h >> np.uint64(32)) | np.uint64(1)


def shard_of(keys: np.ndarray, n: int = SHARDS) -> np.ndarray:
    """Of ``n`` shards, a power of two: the highest bits, so that sorted keys lie shard by shard."""
    return (keys >> np.uint64(64 - int(math.log2(n)))).astype("i8") if n > 1 else np.zeros(len(keys), "i8")


class Filter:
    """The log-frequency Bloom filter: one row of bytes per shard."""

    def __init__(self, shards: np.ndarray) -> None:
        self.bits = shards                                 # (shards, bytes)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        flat, size = self.bits.reshape(-1), self.bits.shape[1] * 8     # a power of two
        level = np.zeros(len(keys), "i8")
        alive, base, j = np.arange(len(keys)), shard_of(keys, len(self.bits)) * size, 0
        while len(alive) and j < 128:                     # counts up to BASE ** 128
            j += 1
            h, step = _hashes(keys[alive], j)
            for _ in range(PROBES):
                pos = base + (h & np.uint64(size - 1)).astype("i8")
                hit = (flat[pos >> 3] >> (pos & 7).astype("u1")) & 1 > 0
                alive, base, h, step = alive[hit], base[hit], h[hit], step[hit]
                h = h + step
            level[alive] = j
        return level

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Expected counts of n-gram keys, 0 for absent ones."""
        return expected(self.levels(keys))


def size_of(entries: int) -> int:
    """Bits for so many entries, a power of two."""
    return 1 << max(6, math.ceil(math.log2(max(1, BITS_PER_ENTRY * entries))))


def shard_bits(keys: np.ndarray, counts: np.ndarray, size: int | None = None) -> bytes:
    """One shard of the filter, with the keys under all their levels."""
    top = levels(counts)
    size = size or size_of(int(top.sum()))
    bits, level = np.zeros(size, bool), 0
    while len(keys):                                       # levels 1, 2, ... of what still has one
        level += 1
        h, step = _hashes(keys, level)
        for _ in range(PROBES):
            bits[(h & np.uint64(size - 1)).astype("i8")] = True
            h = h + step
        more = top > level
        keys, top = keys[more], top[more]
    return np.packbits(bits, bitorder="little").tobytes()


class Model:
    """The shards of the filter (s, bits), their number, N and V; the exact table of words is kept beside it."""

    def __init__(self, shards: DataFrame, n_shards: int, tokens: int, distinct: int) -> None:
        self.shards, self.n_shards, self.tokens, self.distinct = shards, n_shards, tokens, distinct

    @property
    def denominator(self) -> int:
        return self.tokens + self.distinct + 1


class Ids(dict):
    """Words numbered as they appear."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def tokens_of(text: bytes | None) -> list[bytes]:
    return words_of((text or b"").lower()) + [END]          # bytes.lower() folds A-Z alone


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(col(docs, id_col).alias("id"), F.encode(col(docs, text_col), "UTF-8").alias("t"))


class Chunk:
    """About CHUNK tokens of text, made of the hashes of the words met and the tokens' numbers among them, both as they appeared."""

    def __init__(self, hashes: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(hashes)
        rank = np.empty(len(order), "i8")
        rank[order] = np.arange(len(order))
        self.seen, self.numbers, self.hashes, self.at = hashes, at, hashes[order], rank[at]

    def pairs(self) -> np.ndarray:
        """first * words + second of each token, words numbered by their hashes; every text ends with an end token, which also opens
        the next one and the first."""
        return np.concatenate([self.at[-1:], self.at[:-1]]) * len(self.hashes) + self.at

    def keys(self, codes: np.ndarray) -> np.ndarray:
        return pair_key(self.hashes[codes // len(self.hashes)], self.hashes[codes % len(self.hashes)])


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, Chunk]]:
    """(ids, tokens of each text, chunk)."""
    ids, words, at, sizes, n = [], Ids(), [], [], 0

    def out() -> tuple[pa.Array, np.ndarray, Chunk]:
        return pa.concat_arrays(ids), np.array(sizes, "i4"), Chunk(np.array([digest(w) for w in words], "u8"), np.concatenate(at))

    for b in slices(batches, PIECE):
        get, parts = words.__getitem__, []
        for t in b.column(1).to_pylist():
            w = tokens_of(t)
            parts.append(np.fromiter(map(get, w), "i4", len(w)))
            sizes.append(len(w))
        ids.append(b.column(0))
        at.append(np.concatenate(parts))
        n += len(at[-1])
        del get, parts, t, w
        if n >= CHUNK:
            done = [out()]
            ids, words, at, sizes, n = [], Ids(), [], [], 0    # before the chunk is worked on, not after
            yield done.pop()
    if sizes:
        done = [out()]
        del ids, words, at
        yield done.pop()


def packed(values: np.ndarray, delta: bool = False) -> bytes:
    """Numbers (or their differences) byte plane by byte plane, compressed."""
    own = np.diff(values, prepend=values.dtype.type(0)) if delta else np.ascontiguousarray(values)
    raw = own.view("u1").reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(4, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpacked(data: bytes, kind: str, delta: bool = False) -> np.ndarray:
    raw = pa.Codec("zstd", 1).decompress(data[4:], int.from_bytes(data[:4], "little"), asbytes=True)
    kind = np.dtype(kind)
    out = np.ascontiguousarray(np.frombuffer(raw, "u1").reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    return np.cumsum(out, dtype=kind) if delta else out


def joined(parts: list[bytes], kind: str, delta: bool = False) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *[unpacked(x, kind, delta) for x in parts]])


def bounds_of(shards: np.ndarray, n: int) -> np.ndarray:
    """Where each shard begins among the sorted ``shards``, and the end of the last."""
    return np.searchsorted(shards, np.arange(n + 1))


def blobs(values: np.ndarray, bounds: np.ndarray, delta: bool = False) -> pa.Array:
    """The pieces of ``values`` between ``bounds``, packed."""
    return pa.array([packed(values[lo:hi], delta) for lo, hi in zip(bounds, bounds[1:])], pa.binary())


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows with the same value in their first column, which they are sorted by."""
    key, held = None, []
    for b in slices(batches, PIECE):
        for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]):
            if row[0] != key and held:
                yield key, held
                held = []
            key = row[0]
            held.append(row[1:])
    if held:
        yield key, held


def by_key(rows: DataFrame, *sort: str) -> DataFrame:
    return rows.repartition(n_partitions(rows.sparkSession), sort[0]).sortWithinPartitions(*sort)


def counted(docs: DataFrame, n: int) -> DataFrame:
    """(s, bits, wh, wc, ku, kn), one row a shard: the filter of its pairs, the words dealt to it with their counts, and of the first words
    of its pairs how many different pairs they open."""
    def dealt(c: Chunk) -> pa.RecordBatch:
        v = len(c.hashes)
        codes, times = np.unique(c.pairs(), return_counts=True)
        keys = c.keys(codes)
        shards = shard_of(keys, n)
        order = np.argsort(shards, kind="stable")          # in a shard by the first word's hash
        bounds, ends = bounds_of(shards[order], n), bounds_of(shard_of(c.hashes, n), n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n)), blobs(keys[order], bounds), blobs(c.hashes[codes // v][order], bounds, True),
             blobs(times[order].astype("u4"), bounds), blobs(c.hashes, ends, True), blobs(np.bincount(c.at, minlength=v).astype("u4"), ends)],
            ["s", "pk", "pu", "pc", "wh", "wc"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, c in chunks(batches):
            yield dealt(c)
            del c

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, rows in grouped(batches):
            pk, pu, pc, wh, wc = (joined([r[i] for r in rows], kind, i in (1, 3)) for i, kind in enumerate(("u8", "u8", "u4", "u8", "u4")))
            del rows
            keys, some, place = np.unique(pk, return_index=True, return_inverse=True)
            times = np.bincount(place, pc, len(keys)).astype("i8")
            ku, kn = np.unique(pu[some], return_counts=True)
            words, place = np.unique(wh, return_inverse=True)
            wc = np.bincount(place, wc, len(words)).astype("i8")
            yield pa.RecordBatch.from_arrays([pa.array([s]), *[pa.array([x], pa.binary()) for x in (
                shard_bits(keys, times), packed(words, True), packed(wc), packed(ku, True), packed(kn.astype("i8")))]],
                ["s", "bits", "wh", "wc", "ku", "kn"])

    rows = arrow_map(docs, deal, "s long, pk binary, pu binary, pc binary, wh binary, wc binary")
    return arrow_map(by_key(rows, "s"), add, "s long, bits binary, wh binary, wc binary, ku binary, kn binary")


def word_table(found: DataFrame) -> DataFrame:
    """(h, c, n): every word's exact count and how many different words follow it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for wh, wc, ku, kn in zip(*[c.to_pylist() for c in b.columns]):
                for h, c, n in ((wh, wc, None), (ku, None, kn)):
                    h = unpacked(h, "u8", True).view("i8")
                    c, n = (np.zeros(len(h), "i8") if x is None else unpacked(x, "i8") for x in (c, n))
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), pa.array(n)], ["h", "c", "n"])

    return arrow_map(found.select("wh", "wc", "ku", "kn"), run, "h long, c long, n long").groupBy("h").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def build_filter(words: DataFrame, pairs: DataFrame) -> Filter:
    """The filter of (h, c) and (k, c), k = first << TOP_BITS | second, in one process: for tables that are known to fit it."""
    words, pairs = words.toArrow(), pairs.toArrow()
    k = pairs["k"].to_numpy().view("u8")
    keys = np.concatenate([words["h"].to_numpy().view("u8"), pair_key(k >> np.uint64(TOP_BITS), k & np.uint64(TOP - 1))])
    counts = np.concatenate([words["c"].to_numpy(), pairs["c"].to_numpy()])
    return Filter(np.frombuffer(shard_bits(keys, counts), "u1")[None, :])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", usable: Column | None = None,
        top: int | None = None) -> tuple[Model, DataFrame]:
    """(model, exact table of words (h, c, n)) of the rows of ``docs`` that are ``usable``. All words and pairs are modelled; ``top``,
    once a bound on the words whose pairs were, bounds nothing any more."""
    source = _source(docs.where(usable) if usable is not None else docs, id_col, text_col)
    text = source.agg(F.sum(F.octet_length("t")).alias("n")).first().n or 0
    n = max(SHARDS, 1 << math.ceil(math.log2(max(1, text / SHARD_TEXT))))
    found = stored(counted(source, n), "shards", "zstd")   # a filter's bytes, which fewer ones than zeros fill, repeat nothing but pack well
    release(docs.sparkSession)                             # the pairs' exchange, the largest of all
    words = stored(word_table(found), "words")
    release(docs.sparkSession)
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    return Model(found.select("s", "bits"), n, total.n, total.v), words


def numbered(docs: DataFrame, id_type: str) -> DataFrame:
    """(chunk, ids, sizes, hashes, at), one row a chunk of text: the texts as numbers of their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 40
        for ids, sizes, c in chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                              *[pa.array([x], pa.binary()) for x in (packed(sizes), c.seen.tobytes(), packed(c.numbers))]],
                                             ["chunk", "ids", "sizes", "hashes", "at"])
            chunk += 1

    return arrow_map(docs, run, f"chunk long, ids array<{id_type}>, sizes binary, hashes binary, at binary")


def asked(texts: DataFrame, n: int) -> DataFrame:
    """(s, chunk, pk, wh): the pairs and words that a chunk asks shard s for, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                c = Chunk(np.frombuffer(b.column(1)[i].as_py(), "u8"), unpacked(b.column(2)[i].as_py(), "i4"))
                keys = np.sort(c.keys(np.unique(c.pairs())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n)), pa.array(np.full(n, b.column(0)[i].as_py())), blobs(keys, bounds_of(shard_of(keys, n), n), True),
                     blobs(c.hashes, bounds_of(shard_of(c.hashes, n), n), True)], ["s", "chunk", "pk", "wh"])

    return arrow_map(texts.select("chunk", "hashes", "at"), run, "s long, chunk long, pk binary, wh binary")


def answered(texts: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """(chunk, s, level, c, n): the levels of the pairs, and the counts and followers of the words, that a chunk asked shard s for."""
    n = model.n_shards

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy().view("u8")
            order = np.argsort(h)
            h, ends = h[order], bounds_of(shard_of(h[order], n), n)
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), blobs(h, ends, True), blobs(b.column(1).to_numpy()[order], ends),
                                               blobs(b.column(2).to_numpy()[order], ends)], ["s", "x", "y", "z"])
            yield rows.filter(pa.array(np.diff(ends) > 0))

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, bits in zip(b.column(0), b.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array([s.as_py()]), pa.array([packed(np.frombuffer(bits.as_py(), "u1"))], pa.binary())], ["s", "x"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, bits, held, table = None, None, [], None
        for b in slices(batches, PIECE):
            out: list[tuple] = []
            for s, kind, chunk, x, y, z in zip(*[c.to_pylist() for c in b.columns]):
                if s != shard:
                    shard, bits, held, table = s, None, [], None
                if kind == 0:
                    bits = Filter(unpacked(x, "u1")[None, :])
                elif kind == 1:
                    held.append((x, y, z))
                else:
                    if table is None:
                        h, c, k = (joined([r[i] for r in held], t, i == 0) for i, t in enumerate(("u8", "i8", "i8")))
                        order, held = np.argsort(h), []
                        table = h[order], c[order], k[order]
                    h, c, k = table
                    own = unpacked(y, "u8", True)
                    place = np.minimum(np.searchsorted(h, own), max(len(h) - 1, 0))
                    here = h[place] == own if len(h) else np.zeros(len(own), bool)
                    counts = [packed(np.where(here, v[place] if len(h) else 0, 0).astype("i8")) for v in (c, k)]
                    keys = unpacked(x, "u8", True)
                    level = bits.levels(keys) if bits is not None else np.zeros(len(keys))
                    out.append((chunk, s, packed(level.astype("u1")), *counts))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (pa.int64(), pa.int64(), *[pa.binary()] * 3))],
                                                 ["chunk", "s", "level", "c", "n"])

    none = F.lit(None)
    rows = arrow_map(model.shards.select("s", "bits"), bare, "s long, x binary").select(
        "s", F.lit(0).alias("kind"), none.cast("long").alias("chunk"), "x", none.cast("binary").alias("y"), none.cast("binary").alias("z"))
    rows = rows.unionByName(arrow_map(words.select("h", "c", "n"), deal, "s long, x binary, y binary, z binary").select(
        "s", F.lit(1).alias("kind"), none.cast("long").alias("chunk"), "x", "y", "z"))
    rows = rows.unionByName(asked(texts, n).select("s", F.lit(2).alias("kind"), "chunk", F.col("pk").alias("x"), F.col("wh").alias("y"),
                                                        none.cast("binary").alias("z")))
    return arrow_map(by_key(rows, "s", "kind"), answer, "chunk long, s long, level binary, c binary, n binary")


def score(docs: DataFrame, model: Model, words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score), one row per row of ``docs``."""
    source = _source(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()
    texts = stored(numbered(source, id_type), "texts")
    tokens, denominator = model.tokens, model.denominator

    def scored(rows: list[tuple]) -> pa.RecordBatch:       # the chunk's own row, then its answers shard by shard
        _, _, _, _, ids, sizes, hashes, at = rows[0]
        sizes, chunk = unpacked(sizes, "i4").astype("i8"), Chunk(np.frombuffer(hashes, "u8"), unpacked(at, "i4"))
        codes, at = np.unique(chunk.pairs(), return_inverse=True)
        answers, c, n = (joined([r[i] for r in rows[1:]], t) for i, t in ((1, "u1"), (2, "i8"), (3, "i8")))
        level = np.empty(len(codes), "i8")
        level[np.argsort(chunk.keys(codes))] = answers
        first, second = codes // len(c), codes % len(c)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        one, followers, context = (c[second] + 1) / denominator, n[first], c[first]
        pair = np.minimum(expected(level), np.minimum(context, c[second]))
        # Witten-Bell: every token of the context is followed by one, of so many different ones
        p = np.where(context > 0, (pair + followers * one) / np.maximum(context + followers, 1), one)
        exact = np.add.reduceat(np.log10(c[second] + 1.0)[at], starts) - sizes * math.log10(denominator)
        score = np.add.reduceat(np.log10(np.minimum(p, 1.0))[at], starts)
        known = np.add.reduceat((c[second] > 0).astype("i8")[at], starts)
        zero = np.zeros(len(sizes))
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(sizes), pa.array(known), pa.array(exact if tokens else zero),
                                          pa.array(score if tokens else zero)], ["id", "n_tokens", "n_known", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches):
            yield scored(rows)
            del rows

    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(source.schema["id"].dataType)
    none = F.lit(None).cast("binary")
    rows = texts.select("chunk", F.lit(-1).cast("long").alias("s"), none.alias("level"), none.alias("c"), none.alias("n"), "ids", "sizes", "hashes", "at")
    answers = stored(answered(texts, model, words), "answers")
    release(docs.sparkSession)                             # the questions' exchange is gone before the answers' begins
    rows = rows.unionByName(answers, allowMissingColumns=True)
    return arrow_map(by_key(rows, "chunk", "s"), run, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    from .langid import fold

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model, words = fit(docs, usable=fold(F.col("doc_id"), 7) != 2)
    out = score(docs, model, words)
    discard(model.shards, words)                           # what follows reads the texts and their answers alone
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
