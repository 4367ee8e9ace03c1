"""BPE encoding and decoding (operator 8) with a minimal acyclic transducer as lexicon.

The most frequent words of the corpus are compiled, with their ids as outputs, into a shared-suffix
automaton: numbers on the arcs add up to a word's rank, and the rank leads to its ids. The
automaton is broadcast (at most ``lexicon`` words of at most ``MAX_WORD`` bytes, so its size has a fixed
bound), each task maps it into memory, and words it does not hold are merged exactly. Texts are never
shuffled; counting words shuffles one partial count per word and task.

Defined cases: a null or empty text has no tokens and decodes to the empty text; null ids and repeated
rows are rows like others; an empty table gives an empty
table; only the two named columns are read. The special tokens' strings inside a text become
their ids, as in the tokenizers library. Normal forms depend on the edition of Unicode: texts with code
points unassigned in Python's tables, or with a run of combining marks beyond U+0300-036F, are encoded by
the library itself.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, commonest, slices, stored
from .packing import byte_symbols

#: Bounds of the broadcast lexicon.
LEXICON, MAX_WORD = 50_000, 64
#: Distinct words that a worker keeps at hand, and those a task counts before it hands them on.
HELD, COUNTED = 300_000, 200_000


NO_MERGE, NO_RANK = 1 << 62, np.int32((1 << 31) - 1)


def padded(words: list[bytes], block: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, bytes, lengths) of the words of 1 to MAX_WORD bytes, those of about one length as one matrix of ``block`` rows at most."""
    length = np.array([len(w) for w in words], "i8")
    flat, starts = np.frombuffer(b"".join(words), "u1"), np.cumsum(length) - length
    low, size = 0, 8
    while low < MAX_WORD:
        index = np.flatnonzero((length > low) & (length <= min(size, MAX_WORD)))
        for at in range(0, len(index), block):
            own = index[at:at + block]
            n, cols = length[own], np.arange(size)
            raw = flat[np.minimum(starts[own][:, None] + cols, len(flat) - 1)]
            yield own, np.where(cols < n[:, None], raw, np.uint8(0)), n
        low, size = size, size * 2


class Merges:
    """Vocabulary and merge rules of a tokenizers file with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        # ids below 2**20: a pair is one number, and so is its rank with the id of what it becomes
        self.pairs = {vocab[a] << 20 | vocab[b]: i << 20 | vocab[a + b] for i, (a, b) in enumerate(pairs)}
        symbols = byte_symbols()
        self.start = {b: vocab[c] for c, b in symbols.items()}
        self.last = {b: vocab[c + end] for c, b in symbols.items()}
        # the same as arrays, for many words at once: sorted pairs, and what every two bytes are as neighbours
        self.codes = np.array(sorted(self.pairs), "i8")
        self.ranks = np.array([self.pairs[c] >> 20 for c in self.codes.tolist()], "i4")
        self.become = np.array([vocab[a + b] for a, b in pairs], "i4")
        self.inner, self.final = (np.array([of[b] for b in range(256)], "i4") for of in (self.start, self.last))
        self.inner_pairs, self.final_pairs = (self.look_up(np.repeat(self.inner, 256), np.tile(of, 256)).reshape(256, 256)
                                              for of in (self.inner, self.final))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        # for texts up to U+036F, which are nearly all, the classes are spelt out: plain character sets are faster
        for name in "LN":
            own = "".join(re.escape(chr(c)) for c in range(0x370) if unicodedata.category(chr(c))[0] == name)
            pattern = pattern.replace(f"\\p{{{name}}}", own)
        self.near = re.compile(pattern.replace(r"\s", r" \t-\r\x85\xa0"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def merge(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first."""
        part = [self.start[b] for b in word]
        part[-1] = self.last[word[-1]]
        if len(part) > MAX_WORD:
            return self.merge_long(part)
        get, none = self.pairs.get, NO_MERGE
        found = [get(a << 20 | b, none) for a, b in zip(part, part[1:])]       # rank and result of each neighbouring pair
        while found:
            best = min(found)
            if best == none:
                break
            i, new = found.index(best), best & 0xFFFFF
            part[i:i + 2] = [new]
            del found[i]
            if i:
                found[i - 1] = get(part[i - 1] << 20 | new, none)
            if i < len(found):
                found[i] = get(new << 20 | part[i + 1], none)
        return part

    def merge_long(self, part: list[int]) -> list[int]:
        """The same with a heap: near-linear, so a word may have any length."""
        n, gone, get, none = len(part), -1, self.pairs.get, NO_MERGE
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(part[i] << 20 | part[i + 1], none)) != none]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if part[i] == gone or j >= n or get(part[i] << 20 | part[j], none) != r:
                continue                                  # a neighbour has been merged meanwhile
            part[i], part[j] = r & 0xFFFFF, gone
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(part[i] << 20 | part[k], none)) != none:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := get(part[h] << 20 | part[i], none)) != none:
                heapq.heappush(heap, (r, h))
        return [p for p in part if p != gone]

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of pairs of ids, NO_RANK where there is no rule."""
        if not len(self.codes):
            return np.full(len(a), NO_RANK, "i4")
        code = a.astype("i8") << 20 | b
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[place] == code, self.ranks[place], NO_RANK)

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words: all words of about one length take one merge each in a step, the lowest rank of its own and the
        leftmost of these, so a step drops one column."""
        out: list = [None] * len(words)
        for index, raw, n in padded(words):
            rows, size = np.arange(len(raw)), raw.shape[1]
            part = self.inner[raw]
            part[rows, n - 1] = self.final[raw[rows, n - 1]]
            found = np.full(raw.shape, NO_RANK, "i4")      # column j: the pair of j and j + 1
            found[:, :-1] = self.inner_pairs[raw[:, :-1], raw[:, 1:]]
            found[np.arange(size) >= n[:, None] - 1] = NO_RANK
            two = n > 1
            found[rows[two], n[two] - 2] = self.final_pairs[raw[rows[two], n[two] - 2], raw[rows[two], n[two] - 1]]
            while len(index):
                i = found.argmin(1)
                best = found[np.arange(len(index)), i]
                done = best == NO_RANK
                for k, ids, length in zip(index[done].tolist(), part[done].tolist(), n[done].tolist()):
                    out[k] = ids[:length]
                go = ~done
                index, part, found, n, i, new = index[go], part[go], found[go], n[go] - 1, i[go], self.become[best[go]]
                if not len(index):
                    break
                rows, cols = np.arange(len(index)), np.arange(part.shape[1] - 1)
                part = np.where(cols > i[:, None], part[:, 1:], part[:, :-1])
                found = np.where(cols >= i[:, None], found[:, 1:], found[:, :-1])
                part[rows, i] = new
                after, before = i + 1 < n, i > 0
                r, k = rows[after], i[after]
                found[r, k] = self.look_up(new[after], part[r, k + 1])
                r, k = rows[before], i[before]
                found[r, k - 1] = self.look_up(part[r, k - 1], new[before])
        for k, word in enumerate(words):
            if out[k] is None:
                out[k] = self.merge(word)
        return out

    def words(self, text: str) -> list[str]:
        """Normal form C, lower case by code point (no final sigma), then the splitting pattern; white
        space separates and is never part of a word."""
        if text.isascii():                                 # is its own normal form
            return self.near.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (self.pattern if FAR_RX.search(text) else self.near).findall(text)

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary has no decoder: tokens are joined by blanks, word ends included."""
        return " ".join(map(self.tokens.__getitem__, ids))


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic automaton of the words, built from their sorted order, as one block of bytes.

    Layout, all little-endian 32-bit: numbers of states, arcs and words; the first arc of each state, with the
    final mark in bit 31; target of each arc; what each arc adds to the rank; the start of each word's
    ids; the ids; and at last one byte per arc, its label.
    """
    # a state while it can still grow: [final, {label: state}]; finished ones are shared by their content
    finished: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]]]] = []
    reach: list[int] = []                                 # words that end in a state or beyond it

    def finish(state: list) -> int:
        arcs = [(label, child) for label, child in state[1].items()]
        key = (state[0], tuple(arcs))
        if key not in finished:
            finished[key] = len(states)
            states.append((state[0], arcs))
            reach.append(state[0] + sum(reach[c] for _, c in arcs))
        return finished[key]

    path: list[list] = [[False, {}]]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            done = finish(path.pop())
            path[-1][1][last[len(path) - 1]] = done

    order = sorted(words)
    for w in order:
        same = next((i for i, (a, b) in enumerate(zip(w, last)) if a != b), min(len(w), len(last)))
        close(same)
        for b in w[same:]:
            path[-1][1][b] = -1
            path.append([False, {}])
        path[-1][0] = True
        last = w
    close(0)
    root = finish(path[0])

    first, target, add, label = [], [], [], bytearray()
    for final, arcs in states:
        first.append(len(target) | final << 31)
        skip = int(final)
        for b, child in arcs:
            target.append(child)
            add.append(skip)
            label.append(b)
            skip += reach[child]
    first.append(len(target))
    ids = [words[w] for w in order]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype="i8")])
    head = [len(states), len(target), len(order), root]
    numbers = np.concatenate([np.array(x, "u4") for x in (head, first, target, add, starts, [i for x in ids for i in x])])
    return numbers.astype("<u4").tobytes() + bytes(label)


LABELS = [bytes([b]) for b in range(256)]


class Lexicon:
    """A compiled lexicon mapped into memory."""

    def __init__(self, block: bytes) -> None:
        with tempfile.TemporaryFile() as f:               # without a name: nothing is left behind
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), len(block), access=mmap.ACCESS_READ)
        n, arcs, count, self.root = np.frombuffer(self.map, "<u4", 4).tolist()
        numbers = memoryview(self.map)[:len(block) - arcs].cast("I")
        at = 4
        self.first, at = numbers[at:at + n + 1], at + n + 1
        self.target, at = numbers[at:at + arcs], at + arcs
        self.add, at = numbers[at:at + arcs], at + arcs
        self.start, at = numbers[at:at + count + 1], at + count + 1
        self.ids = numbers[at:]
        self.labels = len(block) - arcs
        # arcs by (state, label): they lie in this order
        out = np.frombuffer(self.first, "<u4") & 0x7FFFFFFF
        labels = np.frombuffer(self.map, "u1", arcs, self.labels)
        self.arcs = np.repeat(np.arange(n, dtype="i8"), np.diff(out.astype("i8"))) << 8 | labels

    def get(self, word: bytes) -> list[int] | None:
        state, rank, first = self.root, 0, self.first
        for b in word:
            lo, hi = first[state] & 0x7FFFFFFF, first[state + 1] & 0x7FFFFFFF
            arc = self.map.find(LABELS[b], self.labels + lo, self.labels + hi) - self.labels
            if arc < 0:
                return None
            rank += self.add[arc]
            state = self.target[arc]
        if not first[state] >> 31:
            return None
        return self.ids[self.start[rank]:self.start[rank + 1]].tolist()


    def get_many(self, words: list[bytes]) -> list[list[int] | None]:
        """``get`` of many words: all of about one length walk the automaton together, a byte a step."""
        found: list[list[int] | None] = [None] * len(words)
        if not len(self.arcs):
            return [self.get(w) if len(w) <= MAX_WORD else None for w in words]
        first, target, add, start = (np.frombuffer(x, "<u4") for x in (self.first, self.target, self.add, self.start))
        for index, raw, n in padded(words):
            state, rank = np.full(len(raw), self.root, "i8"), np.zeros(len(raw), "i8")
            for j in range(raw.shape[1]):
                code = state << 8 | raw[:, j]
                arc = np.minimum(np.searchsorted(self.arcs, code), len(self.arcs) - 1)
                on = self.arcs[arc] == code
                index, raw, n, arc = index[on], raw[on], n[on], arc[on]
                state, rank = target[arc].astype("i8"), rank[on] + add[arc]
                end = n == j + 1
                if end.any():
                    full = end & (first[state] >> 31 > 0)
                    for k, lo, hi in zip(index[full].tolist(), start[rank[full]].tolist(), start[rank[full] + 1].tolist()):
                        found[k] = self.ids[lo:hi].tolist()
                    index, raw, n, state, rank = index[~end], raw[~end], n[~end], state[~end], rank[~end]
                if not len(index):
                    break
        return found


def frequent_words(docs: DataFrame, text_col: str, vocab: str, limit: int = LEXICON) -> list[str]:
    """The most frequent words of all texts, at most ``limit``, of at most MAX_WORD bytes each; words of (nearly) equal
    frequency are all in or all not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, counts = Merges(vocab), Counter()
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                              ["word", "n"])
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                if text:
                    counts.update(rules.words(text))
            if len(counts) > COUNTED:
                yield out()
                counts.clear()
        yield out()

    counts = arrow_map(docs.select(col(docs, text_col).alias("t")), run, "word string, n long")
    counts = counts.where(F.octet_length("word") <= MAX_WORD).groupBy("word").agg(F.sum("n").alias("n"))
    top = commonest(stored(counts, "words"), "n", limit)
    return top.select("word").toArrow()["word"].to_pylist()      # bounded by ``limit``


def build(docs: DataFrame, vocab: str, text_col: str = "text", limit: int = LEXICON) -> bytes:
    words = [w.encode() for w in frequent_words(docs, text_col, vocab, limit)]
    return compile_lexicon(dict(zip(words, Merges(vocab).merge_many(words))))


#: Up to U+036F every code point is assigned and every mark is an old one.
FAR_RX = re.compile("[^\0-\u036F]")


@functools.cache
def odd() -> regex.Pattern:
    """Where classes or normal forms may differ between editions of Unicode."""
    free = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for c, p in zip(free, [None, *free]) if p != c - 1]
    ends = [c for c, n in zip(free, [*free[1:], None]) if n != c + 1]
    runs = "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(starts, ends))
    far = r"[\p{M}--[\u0300-\u036F]]"
    return regex.compile(rf"(?V1)[\p{{Cn}}{runs}]|{far}\p{{M}}|\p{{M}}{far}")


def is_odd(text: str) -> bool:
    return not text.isascii() and bool(FAR_RX.search(text)) and bool(odd().search(text))


class Known:
    """The ids (packed) and the decoded forms of words, kept at hand in two generations: when the young one is full it becomes the
    old one, and what is met again moves back, so frequent words stay and memory has a bound."""

    def __init__(self, rules: Merges, lexicon: Lexicon) -> None:
        self.rules, self.lexicon = rules, lexicon
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def of(self, words: set[str]) -> dict[str, tuple[bytes, str]]:
        """A dict that holds all ``words``; those at hand nowhere are looked up, or merged, together."""
        if len(self.young) >= HELD // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for w in words.difference(young):
            if (both := old.get(w)) is not None:
                young[w] = both
            else:
                new.append(w)
        raw = [w.encode() for w in new]
        found = self.lexicon.get_many(raw)
        rest = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(rest, self.rules.merge_many([raw[k] for k in rest])):
            found[k] = x
        # all ids and their tokens in one run, of which each word has its part
        packed = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        names = [*map(self.rules.tokens.__getitem__, chain.from_iterable(found))]
        long: list[str] = []
        at = 0
        for w, b, x in zip(new, raw, found):
            end = at + len(x)
            young[w] = packed[4 * at:4 * end], " ".join(names[at:end])
            at = end
            if len(b) > MAX_WORD:
                long.append(w)
        if not long:
            return young
        out = dict(young)
        for w in long:                                     # words without a bound are not kept
            del young[w]
        return out


class Encoder:
    def __init__(self, vocab: str, lexicon: bytes) -> None:
        self.rules, self.vocab = Merges(vocab), vocab
        self.lexicon = Lexicon(lexicon)
        self.known = Known(self.rules, self.lexicon)
        self.library = None

    def encode(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text)."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """``encode`` of several texts, whose unseen words are merged together."""
        # of each text its parts: lists of words, and between them special tokens; null where the library encodes
        split = [None if is_odd(t) else [p if k % 2 else self.rules.words(p) for k, p in
                                         enumerate(self.rules.specials.split(t) if "<|" in t else [t])] for t in texts]
        known = self.known.of(set().union(*(p for parts in split if parts for p in parts[::2])))
        return [self.by_library(t) if parts is None else self.joined(parts, known) for t, parts in zip(texts, split)]

    def joined(self, parts: list, known: dict[str, tuple[bytes, str]]) -> tuple[bytes, str]:
        ids: list[bytes] = []
        text: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(struct.pack("<I", self.rules.special[part]))
                text.append(part)
            else:
                both = [*map(known.__getitem__, part)]
                ids += [x for x, _ in both]
                text += [x for _, x in both]
        return b"".join(ids), " ".join(text)

    def by_library(self, text: str) -> tuple[bytes, str]:
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.vocab)
            self.library.no_truncation()
            self.library.no_padding()
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes(), self.library.decode(ids, skip_special_tokens=False)


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Without Python's collector of cycles, which would walk the words at hand again and again: encoding makes no cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


_KEPT: dict[tuple[str, bytes], Encoder] = {}


def encoder_of(vocab: str, lexicon: bytes) -> Encoder:
    """The worker's encoder: later tasks of the same job find its words at hand."""
    key = vocab, hashlib.sha256(lexicon).digest()
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Encoder(vocab, lexicon)
    return _KEPT[key]


def encode(docs: DataFrame, vocab: str, lexicon: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded), one row per row of ``docs``; ids as little-endian unsigned 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    source = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocab, shared.value)
        for b in slices(batches, 1 << 20):
            with uncollected():
                both = encoder.encode_all([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in both], pa.binary()), pa.array([x for _, x in both], pa.string())],
                ["id", "ids", "decoded"])

    return arrow_map(source, run, source.select("id").schema.add("ids", "binary").add("decoded", "string"))


def decode(encoded: DataFrame, vocab: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """(row's columns, text decoded from ids)."""
    names = [c for c in encoded.columns if c.lower() != out_col.lower()]
    source = encoded.select([col(encoded, c) for c in names])
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Merges(vocab)
        for b in slices(batches):
            texts = [None if x is None else rules.decode(np.frombuffer(x, "<u4").tolist()) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*names, out_col])

    return arrow_map(source, run, source.select("*").schema.add(out_col, "string"))


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocab = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode(docs, vocab, build(docs, vocab))
    return out.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
