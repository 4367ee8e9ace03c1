"""Lexical search, importance resampling, exact top-k: brute force, DuckDB, odd rows, empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from standlens.llm import importance, lexical, topk
from standlens.llm.common import term_pieces

from . import brute

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def last(i):
    return (i is None, 0 if i is None else i)


# ranked lexical search

def ranked(docs, items, k=20):
    counts = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    counts = [c for c in counts if c[2]]
    n_docs, total = len(counts), sum(n for *_, n in counts)
    out = []
    for item, text in items:
        found = []
        for i, tf, n in counts:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = 0
            for t, reps in Counter(terms(text)).items():
                if tf[t]:
                    df = sum(t in c for _, c, _ in counts)
                    score += reps * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((score, i))
        found.sort(key=lambda x: (-x[0], last(x[1])))
        out += [(item, rank, i, score) for rank, (score, i) in enumerate(found[:k], 1)]
    return Counter(out)


def search_rows(spark, docs, items, parts=4, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    b = spark.createDataFrame(items, "item_id string, text string")
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in lexical.search(d, b, **kw).collect())


WORDS = "the a river Über été 中文 x-ray don't 42 3.14 THE Abc abc abcd bcd ÉTÉ".split()


def some_texts(rng, n, most=12):
    return [" ".join(rng.choices(WORDS, k=rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("limit", [lexical.BLOCK, 40])
def test_search_matches_brute_force_in_one_block_and_in_many(spark, limit):
    rng = random.Random(3)
    docs = list(enumerate(some_texts(rng, 120))) + [(i, t) for i, t, _ in brute.ODD]
    items = [(f"q{i}", t) for i, t in enumerate(some_texts(rng, 9, 6))] + [("none", None), ("empty", " .,-"), ("long", " ".join(WORDS) * 3)]
    assert search_rows(spark, docs, items, k=7, limit=limit) == ranked(docs, items, 7)


def test_search_breaks_ties_by_id_however_many_rows_share_a_score(spark):
    docs = [(i, "hot term here") for i in range(3000)] + [(i, "cold words") for i in range(3000, 6100)] + [(None, "hot term here")] * 5
    random.Random(1).shuffle(docs)
    got = search_rows(spark, docs, [("q", "hot")], k=20)
    assert got == ranked(docs, [("q", "hot")]) and {i for _, _, i, _ in got} == set(range(20))
    few = search_rows(spark, docs[:0] + [(5, "hot"), (None, "hot"), (5, "hot"), (6, "cold and dry"), (7, "x")], [("q", "hot")])
    assert sorted((rank, last(i)) for _, rank, i, _ in few.elements()) == [(1, (False, 5)), (2, (False, 5)), (3, (True, 0))]


def test_best_keeps_the_best_when_it_forgets():
    rng, own = np.random.default_rng(2), lexical.Best(5, 3)
    own.most = 40
    rows = []
    for doc in rng.permutation(400):
        items = np.flatnonzero(rng.random(5) < 0.6)
        scores = rng.integers(1, 6, len(items))
        none = bool(rng.random() < 0.1)
        rows += [(int(i), -int(s), none, 0 if none else int(doc)) for i, s in zip(items, scores)]
        own.add(items, scores, none, 0 if none else int(doc))
    items, scores, none, doc = own.cut()
    want = [r for i in range(5) for r in sorted(x for x in rows if x[0] == i)[:3]]
    assert [(int(i), -int(s), bool(n), int(d)) for i, s, n, d in zip(items, scores, none, doc)] == want


def test_long_texts_are_scanned_whole_in_pieces():
    rng = random.Random(8)
    text = " ".join(rng.choices(WORDS, k=50_000)).encode()
    machine = lexical.automaton("\n".join(sorted({t.encode().decode("latin-1") for t in terms(" ".join(WORDS))})))
    n, found = lexical.scan(text, machine)
    assert n == len(terms(text.decode())) and sorted(found.values()) == sorted(Counter(terms(text.decode())).values())
    pieces = list(term_pieces(b"ab cd " * 50, limit=16))
    assert len(pieces) > 10 and b"".join(p[1:] for p in pieces).split() == [b"ab", b"cd"] * 50
    assert list(term_pieces(b"x" * 100, limit=8)) == [b" " + b"x" * 100 + b" "]


def test_search_odd_rows_clashing_columns_and_empty_tables(spark):
    docs, empty = brute.odd_docs(spark), brute.empty_docs(spark)
    items = spark.createDataFrame([(1, "hello world", "x"), (1, "hello world", "x"), (None, "fine ten", "y"), (2, None, "z")],
                                  "item_id long, text string, score string")
    got = Counter(tuple(r) for r in lexical.search(docs, items).collect())
    assert got == ranked([(i, t) for i, t, _ in brute.ODD], [(1, "hello world"), (1, "hello world"), (None, "fine ten")])
    assert lexical.search(empty, items).collect() == [] and lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs, items.where("text IS NULL")).columns == ["item_id", "rank", "doc_id", "score"]


# importance resampling

def scored(docs, target, buckets=10_000):
    def hashes(text):
        w = terms(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    own, wanted = Counter(h for _, t in docs for h in hashes(t)), Counter(h for t in target for h in hashes(t))
    s, t = sum(own.values()), sum(wanted.values())
    gain = {h: math.floor(1000 * math.log((wanted[h] + 1) * (s + buckets) / ((own[h] + 1) * (t + buckets)))) for h in own}
    out = []
    for i, text in docs:
        h = hashes(text)
        u = (int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        weight = sum(gain[x] for x in h)
        out.append((i, len(terms(text)), len(h), weight, weight + math.floor(-1000 * math.log(-math.log(u)))))
    return out


def resampled(docs, target, percent=5, min_words=20):
    rows = scored(docs, target)
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], last(r[0])))
    won = fit[:percent * len(fit) // 100]
    ranks = Counter((r, k) for k, r in enumerate(won, 1))
    return ranks + Counter((r, None) for r in (Counter(rows) - Counter(won)).elements())


@pytest.mark.parametrize("percent,min_words,pivots", [(5, 20, 24), (30, 3, 2), (100, 0, 1), (0, 0, 3)])
def test_resampling_matches_brute_force(spark, percent, min_words, pivots):
    rng = random.Random(percent)
    docs = list(enumerate(some_texts(rng, 300, 60))) + [(i, t) for i, t, _ in brute.ODD]
    target = some_texts(rng, 20, 30)
    out = importance.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                              spark.createDataFrame([(t,) for t in [*target, None]], "text string"),
                              percent=percent, min_words=min_words, pivots=pivots)
    got = Counter(((r.id, r.n_words, r.n_features, r.weight, r.score), r["rank"]) for r in out.collect())
    assert got == resampled(docs, target, percent, min_words)


def test_selection_finds_every_place_among_ties(spark):
    rows = [(random.Random(i).randint(0, 3), None if i % 7 == 0 else i % 5, i) for i in range(200)]
    df = spark.createDataFrame(rows, "score long, id long, row long").repartition(3).persist()
    want = sorted(rows, key=lambda r: (-r[0], last(r[1]), r[2]))
    for k in (1, 2, 67, 199, 200):
        key = importance.kth(df, k, len(rows), pivots=3)
        assert (-key.s, key.id, key.row) == want[k - 1]
    df.unpersist()


def test_features_go_on_across_pieces(monkeypatch):
    text = " ".join(random.Random(5).choices(WORDS, k=400)).encode()
    whole = [(n, h.tolist()) for n, h in importance.feature_hashes(text)]
    assert len(whole) == 1
    monkeypatch.setattr(importance, "term_pieces", lambda t: term_pieces(t, 7))
    parts = [(n, h.tolist()) for n, h in importance.feature_hashes(text)]
    assert len(parts) > 50 and sum(n for n, _ in parts) == whole[0][0]
    assert Counter(h for _, p in parts for h in p) == Counter(whole[0][1])


def test_resampling_draws_documents_with_their_own_columns(spark):
    docs = brute.odd_docs(spark).where("doc_id > 4")
    ranks = importance.resample(docs, spark.createDataFrame([("word x",)], "text string"), percent=50, min_words=1)
    out = importance.drawn(docs, ranks)
    assert out.columns == docs.columns and out.count() == ranks.where("rank IS NOT NULL").count() == 2
    texts = spark.createDataFrame([(f"k{i}", "some words " * i) for i in range(20)], "name string, body string")
    named = importance.resample(texts, texts, "name", "body", "body", percent=50, min_words=2)
    assert named.where("rank IS NOT NULL").count() == 9
    none = importance.resample(brute.empty_docs(spark), docs)
    assert none.columns == ["id", "n_words", "n_features", "weight", "score", "rank"] and none.count() == 0
    assert importance.resample(docs, brute.empty_docs(spark), min_words=0, percent=100).where("rank IS NULL").count() == 0


# exact top-k

def nearest(rows, k=5, every=50):
    out = []
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for a, (i, q) in enumerate(good):
        if i is not None and i % every == 0:
            s = sorted(((-sum(x * y for x, y in zip(q, v)), last(j)) for b, (j, v) in enumerate(good) if a != b and len(v) == len(q)))
            out += [(i, r, None if j[0] else j[1], -x) for r, (x, j) in enumerate(s[:k], 1)]
    return Counter(out)


def found(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
    return Counter(tuple(r) for r in topk.search(df, is_query=F.col("id") % 50 == 0, **kw).collect())


@pytest.mark.parametrize("block,group", [(4096, 16 << 20), (16, 300)])
def test_topk_matches_brute_force(spark, block, group):
    rng = np.random.default_rng(block)
    rows = [(int(i), rng.normal(size=8).round(2).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.25] * 8) for i in range(300)] + [(None, [0.25] * 8)] * 7 + [(50, [0.25] * 8)] * 2      # ties, null and repeated ids
    rows += [(100, [0.0] * 8), (150, [1.0, 2.0]), (151, [0.5, -1.0]), (200, []), (201, []), (250, None), (251, [1.0, None] * 4),
             (252, [float("nan")] * 8), (253, [float("inf")] * 8), (300, [1.0] * 9)]
    assert found(spark, rows, block=block, group=group) == nearest(rows)


def test_topk_is_exact_beyond_what_doubles_hold(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-2**27, 2**27, 4) / 256.0).tolist()) for i in range(60)]
    rows += [(100 + i, (rng.integers(-100, 100, 4) / 256.0).tolist()) for i in range(60)]
    assert found(spark, rows, parts=2, block=40) == nearest(rows)


def test_topk_stops_before_the_lists_end():
    rng = np.random.default_rng(7)
    x = topk.whole(np.vstack([rng.normal(size=(1500, 8)) * 0.1, np.eye(8)[rng.integers(0, 8, 50)] * rng.uniform(1, 2, (50, 1))]), 256)
    lists = topk.Lists(np.arange(1550), np.arange(1550), np.zeros(1550, bool), x)
    q = topk.whole(np.array([2.0, 0.01, -0.01, 0, 0, 0, 0, 0]), 256)
    bounds = lists.bounds(q[None])[0]
    places, scores, depth = topk.search_block(lists, q, bounds, -1, q[:0], 5)
    best = np.sort(x @ q)[::-1]
    assert depth < 200 and np.array_equal(np.sort(scores)[::-1][:5], best[:5])
    for i, t in enumerate(t for t in lists.depths if t < 1550):
        unseen = np.ones(1550, bool)
        unseen[np.unique(np.r_[lists.down[[0, 1], :t].ravel(), lists.up[[2], :t].ravel()])] = False
        assert (x[unseen] @ q).max() <= bounds[i]
    # a bar from another block ends the search at once
    assert topk.search_block(lists, q, bounds, -1, np.full(5, best[0] * 10), 5)[2] == topk.DEPTH


def test_topk_clashing_columns_and_empty_table(spark):
    rows = [(0, [0.5, 1.0], "a", "b", "c"), (1, [0.25, -1.0], "a", "b", "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, row string, score string")
    assert [tuple(r) for r in topk.search(df, is_query=F.col("id") % 50 == 0).collect()] == [(0, 1, 1, 128 * 64 - 256 * 256)]
    assert topk.search(df.limit(0)).collect() == [] and topk.search(df.where("vec_id = 0")).collect() == []
    assert topk.search(df, k=1).count() == 2


# registered queries against their SQL

@pytest.mark.parametrize("name,sql", [("op11_lexical_search", lexical.OP11_SQL), ("op12_importance", importance.OP12_SQL),
                                      ("op13_topk_search", topk.OP13_SQL)])
def test_query_matches_its_sql(spark, name, sql):
    import duckdb

    from standlens.llm.queries import queries
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{brute.SF}/{t}.parquet')")
    want = con.sql(sql)
    out = queries()[name](spark, brute.SF)
    assert set(out.columns) == set(want.columns)
    got = Counter(tuple(r) for r in out.select(*want.columns).collect())
    assert got == Counter(want.fetchall()) and sum(got.values()) > 0
