r"""Ranked lexical search (operator 11) by an Aho-Corasick scan of the documents.

The terms of all items become one automaton; every term is guarded by a blank on both sides, so only whole terms match. It
is broadcast, and each task scans its texts as they are: there is no index of the documents and no shuffle of them. The first
scan adds up how many documents have terms, how many terms they have, and in how many documents each item term occurs (one row
for each term and task). The second counts tf again, turns it into weights, lets the automaton's outputs lead to the items
that hold the term, and keeps the best documents of each item, so a task hands on ``k`` rows an item at most.

What is broadcast has a bound: items are dealt into blocks of about ``BLOCK`` bytes of text (one item at least), each with an
automaton of its own and two scans of the documents.

Defined cases: a null or empty text has no terms and counts nowhere; very long texts are scanned whole, in pieces that
meet at a blank; of equal scores the smaller id comes first, null ids last; repeated rows are documents, and items, of their
own; an item without terms has no rows; an empty table of either kind gives an empty table; only the named columns are
read, so others may have any name. Document ids are integers; an item id may be of any type.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_map, best_rows, col, slices, stored, term_pieces

#: Bytes of item text whose automaton is broadcast at once.
BLOCK = 8 << 20
#: Candidates that a task holds for each item, in multiples of k, before it forgets all but the best.
SLACK = 8

_TERM_BYTES = bytes(0x20 if i == 0x20 else 0x78 for i in range(256))


def terms_of(text: bytes | None) -> Counter:
    """Occurrences of each term of a text (UTF-8)."""
    found: Counter = Counter()
    for piece in term_pieces(text or b""):
        found.update(piece.split())
    return found


@functools.lru_cache(maxsize=2)      # one for each block; a worker builds it once
def automaton(terms: str) -> ahocorasick.Automaton:
    """Terms (Latin-1 for their bytes, one a line) as patterns between blanks; the output is the term's number."""
    out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, term in enumerate(terms.split("\n")):
        out.add_word(f" {term} ", i)
    out.make_automaton()
    return out


def scan(text: bytes, machine: ahocorasick.Automaton) -> tuple[int, Counter]:
    """Number of terms of a text, and the occurrences of each term of the automaton."""
    n, found = 0, Counter()
    for piece in term_pieces(text):
        n += piece.translate(_TERM_BYTES).count(b" x")
        found.update(map(itemgetter(1), machine.iter(piece.decode("latin-1"))))
    return n, found


class Items:
    """One block of items: the distinct terms, and for each of them the items that hold it and how often."""

    def __init__(self, texts: list[bytes | None]) -> None:
        number: dict[bytes, int] = {}
        rows = [(number.setdefault(t, len(number)), i, n) for i, text in enumerate(texts) for t, n in terms_of(text).items()]
        rows.sort()
        self.n = len(texts)
        self.terms = "\n".join(t.decode("latin-1") for t in number)
        self.n_terms = len(number)
        self.item = np.array([r[1] for r in rows], "i8")
        self.reps = np.array([r[2] for r in rows], "i8")
        self.first = np.searchsorted(np.array([r[0] for r in rows], "i8"), np.arange(len(number) + 1))


class Best:
    """The best rows of each item so far: score, then ids (null last)."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.most = k, max(1 << 16, SLACK * k * n)
        self.least = np.ones(n, "i8")                        # scores must be above 0
        self.least_id = np.full(n, np.iinfo("i8").max)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, items: np.ndarray, scores: np.ndarray, none: bool, doc: int) -> None:
        ok = scores > self.least[items]
        ok |= (scores == self.least[items]) & (none | (doc <= self.least_id[items]))
        if not ok.any():
            return
        items = items[ok]
        self.parts.append((items, scores[ok], np.full(len(items), none), np.full(len(items), doc)))
        self.held += len(items)
        if self.held > self.most:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """Forget all but the best; what is left is sorted."""
        if not self.parts:
            return tuple(np.zeros(0, t) for t in ("i8", "i8", "?", "i8"))
        items, scores, none, doc = (np.concatenate(c) for c in zip(*self.parts))
        by = np.lexsort((doc, none, -scores, items))
        items, scores, none, doc = items[by], scores[by], none[by], doc[by]
        start = np.flatnonzero(np.r_[True, items[1:] != items[:-1]])
        place = np.arange(len(items)) - np.repeat(start, np.diff(np.r_[start, len(items)]))
        last = place == self.k - 1
        self.least[items[last]] = scores[last]
        # a null id at the end stands behind all others: any id may still take its place
        self.least_id[items[last]] = np.where(none[last], np.iinfo("i8").max, doc[last])
        keep = place < self.k
        kept = items[keep], scores[keep], none[keep], doc[keep]
        self.parts, self.held = [kept], int(keep.sum())
        return kept


def statistics(texts: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the number of documents that hold each term of the items."""
    shared = texts.sparkSession.sparkContext.broadcast(items.terms)
    n_terms = items.n_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, df, docs, total = automaton(shared.value), np.zeros(n_terms, "i8"), 0, 0
        for b in slices(batches):
            for t in b.column(1).to_pylist():
                if t:
                    n, found = scan(t, machine)
                    docs, total = docs + (n > 0), total + n
                    if found:
                        df[np.fromiter(found, "i8", len(found))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, at]), pa.array(np.r_[docs, total, df[at]])], ["term", "n"])

    rows = arrow_map(texts, run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()   # one a term
    df, docs, total = np.zeros(n_terms, "i8"), 0, 0
    for r in rows:
        if r.term == -1:
            docs = r.n
        elif r.term == -2:
            total = r.n
        else:
            df[r.term] = r.n
    return docs, total, df


def _ranked(texts: DataFrame, items: Items, ids: list, id_type: pa.DataType, schema, k: int) -> DataFrame | None:
    """The best documents of one block of items that each task found."""
    docs, total, df = statistics(texts, items)
    if not docs:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(n) + 1))) for n in df], "i8")
    shared = texts.sparkSession.sparkContext.broadcast((items, weight, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w, item_ids = shared.value
        machine, best, score = automaton(own.terms), Best(own.n, k), np.zeros(own.n, "i8")
        for b in slices(batches):
            for doc, text in zip(*(c.to_pylist() for c in b.columns)):
                n, found = scan(text, machine) if text else (0, None)
                if not found:
                    continue
                at, tf = np.fromiter(found, "i8", len(found)), np.fromiter(found.values(), "i8", len(found))
                m = 100 - 25 + 25 * n * docs // total
                part = w[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
                lo, size = own.first[at], own.first[at + 1] - own.first[at]
                to = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
                hit = own.item[to]
                np.add.at(score, hit, np.repeat(part, size) * own.reps[to])
                hit = np.unique(hit)
                best.add(hit, score[hit], doc is None, doc or 0)
                score[hit] = 0
        at, score, none, doc = best.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(item_ids, id_type).take(pa.array(at)), pa.array(doc, pa.int64(), mask=none), pa.array(score)],
            ["at", "item_id", "doc_id", "score"])

    return arrow_map(texts, run, schema)


def blocks(items: DataFrame, size: str, limit: int = BLOCK) -> tuple[DataFrame, list[int]]:
    """``items`` with a block number, and the numbers in use: dealt by the row until no block holds more than ``limit`` bytes
    but those of one item."""
    total = items.agg(F.sum(size)).first()[0] or 0
    n = total // limit + 1
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)) if n > 1 else F.lit(0).cast("long"))
        found = dealt.groupBy("block").agg(F.sum(size).alias("b"), F.count("*").alias("n")).collect()     # one a block
        if all(r.b <= limit or r.n == 1 for r in found):
            return dealt, sorted(r.block for r in found)
        n *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", limit: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 of each row of ``items``."""
    spark = docs.sparkSession
    texts = docs.select(col(docs, id_col).cast("long").alias("doc_id"), F.encode(col(docs, text_col), "UTF-8").alias("t"))
    wanted = items.select(col(items, item_col).alias("item_id"), F.encode(col(items, item_text), "UTF-8").alias("t"))
    wanted = stored(wanted.where(F.length("t") > 0).select("*", F.length("t").cast("long").alias("size"),
                                                           F.monotonically_increasing_id().alias("row")), "items")
    item_type = wanted.schema["item_id"].dataType
    schema = wanted.select(F.col("row").alias("at"), "item_id").schema.add("doc_id", "long").add("score", "long")
    dealt, numbers = blocks(wanted, "size", limit)
    found = None
    for b in numbers:
        rows = dealt.where(F.col("block") == b).select("row", "item_id", "t").collect()      # bounded by ``limit``
        rows.sort(key=lambda r: r.row)
        own = Items([bytes(r.t) for r in rows])
        part = own.n_terms and _ranked(texts, own, [r.item_id for r in rows], to_arrow_type(item_type), schema, k)
        if part:
            part = part.withColumn("block", F.lit(b).cast("long"))
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema).withColumn("block", F.lit(0).cast("long"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return best_rows(found, ["block", "at"], order, k, "rank", "doc_id").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"), k=20)


#: DuckDB's lower() folds more than A-Z, so the folding is spelt out.
OP11_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
docs AS MATERIALIZED (SELECT rid, doc_id, ts, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
tot AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM docs),
i AS MATERIALIZED (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
it AS MATERIALIZED (SELECT iid, item_id, term, count(*)::BIGINT AS reps FROM (SELECT iid, item_id, unnest(ts) AS term FROM i) GROUP BY ALL),
tf AS MATERIALIZED (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, n, unnest(ts) AS term FROM docs)
  WHERE term IN (SELECT term FROM it) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, tot),
part AS (SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nd) // nt)))) AS p FROM tf JOIN w USING (term), tot),
s AS (SELECT iid, item_id, rid, doc_id, sum(reps * p)::BIGINT AS score FROM it JOIN part USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST) AS rk FROM s WHERE score > 0)
SELECT item_id, rk::INTEGER AS rank, doc_id, score FROM r WHERE rk <= 20
"""
