"""Packing into fixed windows (operator 4) by Karmarkar-Karp multiway differencing.

One pass tokenizes every text and cuts it at multiples of the capacity: the full pieces are windows by
themselves, what remains is a tail shorter than a window. Tails are dealt to partitions by a hash
of the row and sorted; a task takes them in chunks of ``CHUNK`` and partitions each chunk into
as many windows as its tokens need. Differencing starts with one partial partition per tail, always merges
the two with the largest imbalance, the largest sums of one against the smallest of the other, and ends with
near-equal windows. Where pieces may not be cut, the window count rises until no window exceeds the
capacity; where they may (the contract), what exceeds it is cut off and fills the windows with room.

The unit of work is a chunk, never a key, so rows that share an id, a text or a source are no hot group.
Defined cases: a null or empty text is the end token alone; null ids are packed like others; repeated
rows are packed separately; ties in length go by the row's hash; an empty table gives an empty
table; only the two named columns are read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, n_partitions, slices

CAPACITY = 2048
END = 1
#: Tails that are packed together; also the bound of what a task holds.
CHUNK = 2048
#: Fixed value: the vocabulary's splitting pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the others
    follow from U+0100 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoder(path: str):
    """The byte-level BPE of a tokenizers file, as ranks; its merges are in the order of their ids."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    symbols = byte_symbols()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def difference(lengths: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: ``k`` lists of indexes into ``lengths`` with near-equal sums.

    A partial partition is the list of its non-zero sums in falling order, the other of its ``k`` sums being
    zero; merging adds the i-th largest of one to the i-th smallest of the other.
    """
    if k <= 1 or not lengths:
        return [list(range(len(lengths)))] + [[] for _ in range(k - 1)]
    groups = {i: [i] for i in range(len(lengths))}       # by the name of a sum
    heap = [(-n, i, [(n, i)]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, name, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        over = max(0, len(a) + len(b) - k)               # sums of a that meet a sum of b
        out = a[:len(a) - over] + b[:len(b) - over]
        for i in range(over):
            (x, g), (y, h) = a[len(a) - over + i], b[len(b) - 1 - i]
            groups[g] += groups.pop(h)
            out.append((x + y, g))
        out.sort(reverse=True)
        imbalance = out[0][0] - (out[-1][0] if len(out) == k else 0)
        heapq.heappush(heap, (-imbalance, name, out))
    found = [groups[g] for _, g in heap[0][2]]
    return found + [[] for _ in range(k - len(found))]


def windows(lengths: list[int], capacity: int = CAPACITY, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (index, start, length). Without ``cut`` every length must fit a window."""
    k = -(-sum(lengths) // capacity)
    while True:
        parts = difference(lengths, k)
        sums = [sum(lengths[i] for i in p) for p in parts]
        if cut or max(sums, default=0) <= capacity:
            break
        k += 1
    out = [[(i, 0, lengths[i]) for i in p] for p in parts]
    spare = []                                           # what exceeds the capacity, cut off at the end
    for w, total in zip(out, sums):
        while total > capacity:
            i, start, n = w.pop()
            off = min(n, total - capacity)
            if n > off:
                w.append((i, start, n - off))
            spare.append((i, start + n - off, off))
            total -= off
    room = sorted(((capacity - s, j) for j, s in enumerate(sums) if s < capacity), reverse=True)
    at = 0
    for i, start, n in sorted(spare, key=lambda x: -x[2]):
        while n:
            free, j = room[at]
            take = min(n, free)
            out[j].append((i, start, take))
            start, n, free = start + take, n - take, free - take
            room[at] = (free, j)
            at += not free
    return [w for w in out if w]


def _tokenizer(vocab: str, capacity: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(vocab)
        for b in slices(batches):
            take, start, total, ids = [], [], [], []
            for row, text in enumerate(b.column(2).to_pylist()):
                tokens = np.array(encoder.encode(text or "", allowed_special="all") + [END], "<u4")
                for at in range(0, len(tokens), capacity):
                    take.append(row)
                    start.append(at)
                    total.append(len(tokens))
                    ids.append(tokens[at:at + capacity].astype(width).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(take, pa.int64())), b.column(1).take(pa.array(take, pa.int64())),
                 pa.array(start, pa.int64()), pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
                ["id", "h", "start", "doc_tokens", "ids"])
    return run


def _packer(capacity: int, cut: bool, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32    # windows are numbered inside their partition
        count = 0

        def pieces(rows: pa.RecordBatch, ids: list[np.ndarray], groups: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
            nonlocal count
            flat = [(i, s, n, first + count + w, sum(p[2] for p in group[:k]))
                    for w, group in enumerate(groups) for k, (i, s, n) in enumerate(group)]
            count += len(groups)
            i, s, n, seq, offset = (np.array(x, "i8") for x in zip(*flat)) if flat else [np.array([], "i8")] * 5
            own = rows.take(pa.array(i))
            return pa.RecordBatch.from_arrays(
                [own.column(0), pa.array(own.column(2).to_numpy() + s), pa.array(n), own.column(3), pa.array(seq), pa.array(offset),
                 pa.array([ids[a][b:b + c].astype("<u4").tobytes() for a, b, c, _, _ in flat], pa.binary())],
                ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = [np.frombuffer(x, width) for x in rows.column(4).to_pylist()]
            return pieces(rows, ids, windows([len(x) for x in ids], capacity, cut))

        held, size = [], 0
        for b in slices(batches):
            ids = [np.frombuffer(x, width) for x in b.column(4).to_pylist()]
            full = [i for i, x in enumerate(ids) if len(x) == capacity]
            if full:
                yield pieces(b, ids, [[(i, 0, capacity)] for i in full])
            tails = b.filter(pa.array([len(x) < capacity for x in ids], pa.bool_()))
            while size + tails.num_rows >= CHUNK:
                part = CHUNK - size
                yield packed([*held, tails.slice(0, part)])
                held, size, tails = [], 0, tails.slice(part)
            if tails.num_rows:
                held.append(tails)
                size += tails.num_rows
        if size:
            yield packed(held)
    return run


def pack(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         cut: bool = True) -> DataFrame:
    """(id, start, length, doc_tokens, sequence_id, offset, ids): one row per piece; ``ids`` holds its token
    ids as little-endian unsigned 32-bit integers, the end token (id 1) included.

    ``cut=False`` keeps what is shorter than a window in one piece (longer texts are still cut at
    multiples of the capacity) and lets the window count rise instead.
    """
    width = "<u2" if load_encoder(vocab).max_token_value < 1 << 16 else "<u4"     # of ids on their way
    text, own = col(docs, text_col), col(docs, id_col)
    source = docs.select(own.alias("id"), F.xxhash64(text, own).alias("h"), text.alias("t"))
    cutter = source.select("id", "h").schema.add("start", "long").add("doc_tokens", "long").add("ids", "binary")
    out = source.select("id").schema
    for name in ("start", "length", "doc_tokens", "sequence_id", "offset"):
        out = out.add(name, "long")
    parts = max(1, min(n_partitions(docs.sparkSession), -(-docs.count() // CHUNK)))
    pieces = arrow_map(source, _tokenizer(vocab, capacity, width), cutter)
    dealt = pieces.repartition(parts, "h").sortWithinPartitions("h", "start", "ids")
    return arrow_map(dealt, _packer(capacity, cut, width), out.add("ids", "binary"))


def op4_packing(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    out = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")
