"""Plain versions of the operators' contracts, and tables with odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import xxhash

SF = "/root/testdata/sf0.001"
LONG = "word " * 40_000 + "\n" + "x" * 30_000

ODD = [
    (1, "Hello world. This is fine.\n\nYes, it is: ten words and more stand here.", "en"),
    (1, "Hello world. This is fine.\n\nYes, it is: ten words and more stand here.", "en"),
    (None, "A text without any id is a text like any other one here.", "en"),
    (None, None, None),
    (2, None, "de"),
    (3, "", None),
    (4, "   \t\n  \x0b", "fr"),
    (5, LONG, "en"),
    (6, "é" * 3000, "fr"),
    (7, "x<|endoftext|> y <|startoftext|> z 1234 中文 क्षि", "en"),
    (8, "Mail a.b@mail.example.com or call +1 (555) 123-4567, server 10.0.0.1, card 4111 1111 1111 1111.", "en"),
    (9, "hello WORLD. this is fine.", "en"),
]
EXTRA = "n_lines kept id t h fp salt r1 r2 pos key line start length ids base spans score code v n_words cleaned_text kept_text".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def odd_docs(spark, rows=ODD):
    return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t), *EXTRA) for i, t, g in rows], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf=SF):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf}/documents.parquet'").fetchall()


def crc(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def sha(b) -> str:
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def root_of(up, x):
    while up[x] != x:
        x = up[x]
    return x


def line_dedup(rows, min_docs=10):
    """[(id, n_lines, n_dropped, kept text)]; a document is a distinct (id, text)."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(fold)
    docs = defaultdict(set)
    for i, t in set(rows):
        for line in (t or "").split("\n"):
            docs[key(line)].add((i, t))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (key(x) and len(docs[key(x)]) >= min_docs)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def simhash(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_classes(ids, fps, bits=3):
    up = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                up[root_of(up, a)] = root_of(up, b)
    least = defaultdict(list)
    for a, i in enumerate(ids):
        least[root_of(up, a)].append(i)
    return [min((i for i in least[root_of(up, a)] if i is not None), default=None) for a in range(len(ids))]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    out = []
    for order, (kind, rx) in enumerate(PATTERNS.items()):
        for m in re.finditer(rx, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "phone": 10 <= len(d) <= 15,
                  "card": 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0}
            if ok[kind]:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(out)]


def quality_base(text):
    t = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\f\r")]
    return (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def unigram(rows):
    """{index: (n_tokens, n_known, base_score)} and the number of training tokens."""
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    counts = Counter()
    for i, t in rows:
        if crc(i) % 7 != 2:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
            for w in (tokens(t) for _, t in rows)], n


def pieces_ok(rows, docs, encode, capacity=2048):
    """Checks packed pieces (dicts with ids) of documents [(id, text)]; returns padding over tokens."""
    texts = Counter((i, tuple(encode(t or "") + [1])) for i, t in docs)
    by_window, found = defaultdict(list), defaultdict(list)
    for r in rows:
        by_window[r["sequence_id"]].append(r)
        found[r["id"], r["doc_tokens"]].append(r)
    total = padding = 0
    for window in by_window.values():
        at = 0
        for r in sorted(window, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert at <= capacity
        total, padding = total + at, padding + capacity - at
    got = Counter()
    for (i, n), own in found.items():
        own.sort(key=lambda r: r["start"])
        copies = sum(r["start"] == 0 for r in own)
        by_start = defaultdict(list)
        for r in own:
            by_start[r["start"]].append(r)
        for _ in range(copies):           # equal rows may be cut differently: follow each from its start
            at, ids = 0, b""
            while at < n:
                want = by_start[at].pop()
                ids += want["ids"]
                at += want["length"]
            got[i, tuple(int.from_bytes(ids[k:k + 4], "little") for k in range(0, len(ids), 4))] += 1
        assert not any(by_start.values())
    assert got == texts
    return padding / max(1, total)
