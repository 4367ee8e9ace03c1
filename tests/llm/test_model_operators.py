"""Embedding near-dedup, extraction, packing, LM scoring, BPE, pipeline: brute force, odd rows, empty tables."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from standlens.llm import bpe, embed_dedup, extract, lm, packing, pii

from . import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


# embeddings

def clustered(seed=3, n=400, dim=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = np.vstack([c + rng.normal(size=(20, dim)) * s for c, s in zip(centres, np.linspace(0.02, 0.6, 12))] + [rng.normal(size=(n, dim))])
    return [(int(i), v.tolist()) for i, v in enumerate(x)]


def brute_links(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= threshold
    up = list(range(len(good)))
    for a, b in zip(*np.nonzero(near)):
        ra, rb = brute.root_of(up, a), brute.root_of(up, b)
        up[max(ra, rb)] = min(ra, rb)
    least = {}
    for k, (i, _) in enumerate(good):
        least.setdefault(brute.root_of(up, k), []).append(i)
    out = {i: (int(near[k].sum()) - 1, min(least[brute.root_of(up, k)])) for k, (i, _) in enumerate(good)}
    return out | {i: (0, i) for i, _ in rows if i not in out}


def test_embedding_links_and_recall(spark):
    rows = clustered()
    got = {r.id: (r.n_links, r.component_id) for r in embed_dedup.dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = brute_links(rows)
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in got)


def test_crowded_entries_are_compared_in_blocks(spark):
    rng = np.random.default_rng(9)
    hub = rng.normal(size=64)
    rows = [(i, (hub + rng.normal(size=64) * 0.15).tolist()) for i in range(150)] + [(200 + i, hub.tolist()) for i in range(30)] + [
        (300 + i, rng.normal(size=64).tolist()) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    forms = [{r.id: (r.n_links, r.component_id) for r in embed_dedup.dedup(df, **kw).collect()}
             for kw in ({"crowd": 10_000}, {"crowd": 0, "tile": 7}, {"crowd": 20, "tile": 64})]
    assert forms[0] == forms[1] == forms[2]
    assert sum(n for n, _ in forms[0].values()) >= 0.97 * sum(n for n, _ in brute_links(rows).values())


def test_embedding_odd_vectors(spark):
    v = [0.1 * k - 1 for k in range(64)]
    rows = [(1, v), (2, v), (3, [2 * x for x in v]), (4, None), (5, []), (6, [0.0] * 64), (7, [float("nan")] + v[1:]), (8, [None] + v[1:]),
            (9, [float("inf")] + v[1:]), (10, [-x for x in v]), (11, [1e300 * x for x in v])]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "vec_id long, embedding array<double>, code string, n int")
    got = {r.id: (r.n_links, r.component_id) for r in embed_dedup.dedup(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 11: (3, 1), 10: (0, 10)} | {i: (0, i) for i in (4, 5, 6, 7, 8, 9)}
    assert embed_dedup.dedup(df.limit(0)).count() == 0
    assert embed_dedup.dedup(df.where("vec_id = 4")).collect()[0].n_links == 0


def test_every_pair_of_near_codes_meets_once(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    codes = {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 12))) for _ in range(60)}
    signed = [c - 2**64 if c >> 63 else c for c in sorted(codes)]
    df = spark.createDataFrame([(k, [1.0], c) for k, c in enumerate(signed)], "n long, v array<double>, code long")
    got = Counter((r.a, r.b) for r in embed_dedup.link_pairs(df, embed_dedup._entries(df), 0.5, 11).collect())
    want = Counter((a, b) for b in range(len(signed)) for a in range(b) if ((signed[a] ^ signed[b]) % 2**64).bit_count() <= 11)
    assert got == want


# extraction

def test_minimum_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(600):
        n = rng.randint(1, 8)
        odds = [rng.choice([-3, -1, -.5, .3, .5, 1, 2, 4]) for _ in range(n)]
        edges = [(i, j, rng.random() * 2) for i in range(n) for j in range(i) if rng.random() < .5]

        def cost(labels):
            return (sum(abs(o) for o, x in zip(odds, labels) if (o > 0) != x) + sum(w for i, j, w in edges if labels[i] != labels[j]))
        assert abs(cost(extract.minimum_cut(odds, edges)) - min(map(cost, itertools.product([False, True], repeat=n)))) < 1e-6


PAGE = """<html><head><title>T</title></head><body><header class="top"><a href=/>Home</a> Site</header><div id="cookie-notice">We use cookies.</div>
<nav>x</nav><main><article><header><h1>Title &amp; more</h1></header><p>First   para.<br>line <b>two</b> <a href=x>link</a></p><aside>Buy</aside>
<div class="ad">advert text here that is long enough. Yes.</div><p>Second<p>Third <ul><li>one<li>two</ul><form>mail</form><!-- <p>no</p> --></article>
<section id="comments"><p>Great article, thanks!</p></section></main><div class="sidebar"><p>Related. Long text.</p></div>
<footer>&copy; x</footer><script>if(a<b){"</p>"}</script></body></html>"""


def test_extraction_of_a_page_with_everything():
    assert extract.main_text(PAGE, np.zeros(extract.FEATURES)) == "Title & more\nFirst para. line two link\nSecond\nThird\none\ntwo"


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><article>%s</article><div class='sidebar'><p>Related.</p></div></body>",
    "<html class='no-cookie-banner'><body id='comments-open'><main>%s</main></body></html>",
    "<body><div class='dialog-off-canvas-main-canvas'><div class='nav'><p>Home.</p></div><article>%s</article></div></body>",
    "<form id='search-form'><main class='with-sidebar'>%s</main><aside><article><p>A teaser.</p></article></aside></form>",
    "<body><div class='share-page form'><div class='content'>%s</div></div><footer><p>Imprint.</p></footer></body>"])
def test_wrappers_with_words_against_content_do_not_empty_the_page(page):
    text = ["A first paragraph of the article, long enough to matter here.", "A second one, which is as long as the first and ends too."]
    weights = np.zeros(extract.FEATURES)
    assert extract.main_text(page % "".join(f"<p>{t}</p>" for t in text), weights) == "\n".join(text)
    # hidden wrappers stay hidden, and what is against by itself stays out
    assert extract.main_text("<div class='sidebar' style='display:none'><article><p>Unseen words here.</p></article></div>", weights) == ""
    comments = "<article><p>%s</p></article><section id='comments'><article><p>Nice.</p></article></section>" % text[0]
    assert extract.main_text(comments, weights) == text[0]


@pytest.mark.parametrize("name", "select button object canvas audio video datalist option".split())
def test_an_unclosed_silent_element_does_not_silence_the_page(name):
    weights = np.zeros(extract.FEATURES)
    for page in (f"<article><p>One.</p><{name}><p>Two.</p><p>Three.</p></article>",
                 f"<article><p>One.</p><div><{name}></div><p>Two.</p><p>Three.</p></article><div><{name}>x</{name}></div>",
                 f"<article><p>One.</p><{name}><p>Two.</p><{name}>x</{name}><p>Three.</p></article>"):
        assert extract.main_text(page, weights) == "One.\nTwo.\nThree.", page
    assert extract.main_text(f"<article><p>One.</p><{name}><div>x</div></{name}><p>Two.</p></article>", weights) == "One.\nTwo."


def test_extraction_odd_pages(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, PAGE), (2, "u", ""), (3, "u", "<"), (4, "u", "<a href='x"), (5, "u", "<p>x" * 3000),
            (6, "u", "<div>" * 20_000), (7, "u", "<script>never closed")]
    df = spark.createDataFrame([(i, u, h, "mine", 5) for i, u, h in rows], "page_id long, url string, html string, text string, h int")
    out = extract.extract(df, extract.fit(df)).collect()
    assert len(out) == len(rows) and all(r.text == "" for r in out if r.page_id in (1, 2, 4, 6, 7))
    assert [r.text.split("\n")[0] for r in out if r.page_id is None] == ["Title & more"]
    empty = df.limit(0)
    assert extract.extract(empty, extract.fit(empty)).count() == 0


def test_extraction_of_given_pages(spark):
    df = spark.read.parquet(f"{brute.SF}/pages.parquet")
    out = extract.extract(df, extract.fit(df)).join(df.select("page_id", "html"), "page_id").collect()
    import html
    import re
    for r in out:
        article = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in blocks if x)


# packing

def test_differencing_and_windows():
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 60, 400):
        lengths = [rng.randint(1, 2047) for _ in range(n)]
        k = max(1, -(-sum(lengths) // 2048))
        parts = packing.difference(lengths, k)
        assert len(parts) == k and sorted(i for p in parts for i in p) == list(range(n))
        for cut in (True, False):
            seen = {}
            got = packing.windows(lengths, 2048, cut)
            for w in got:
                assert sum(m for _, _, m in w) <= 2048
                for i, s, m in w:
                    seen.setdefault(i, []).append((s, m))
            for i, total in enumerate(lengths):
                at = 0
                for s, m in sorted(seen[i]):
                    assert s == at and m > 0
                    at += m
                assert at == total and (cut or len(seen[i]) == 1)
            assert not cut or len(got) == -(-sum(lengths) // 2048)
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in packing.difference([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]                  # the textbook example of differencing


def test_packing_round_trip(spark):
    docs = [(i, t) for i, t, _ in brute.documents()] + [(i, t) for i, t, _ in brute.ODD]
    library = Tokenizer.from_file(BYTE)
    df = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, h string").repartition(3)
    rows = [r.asDict() for r in packing.pack(df, BYTE).collect()]
    assert brute.pieces_ok(rows, docs, lambda t: library.encode(t, add_special_tokens=False).ids) < 0.03
    whole = [r.asDict() for r in packing.pack(df, BYTE, cut=False).collect()]
    brute.pieces_ok(whole, docs, lambda t: library.encode(t, add_special_tokens=False).ids)
    assert packing.pack(df.limit(0), BYTE).count() == 0


def test_both_tokenizers_agree_on_odd_texts():
    library, own = Tokenizer.from_file(BYTE), packing.load_encoder(BYTE)
    for t in ["a" * 50_000, " " * 9_000 + "x", "é" * 500, "\n \n\t x", "<|endoftext|>a<|endoftext|>", "क्ष \U0001f600 \x00\x85 ", *(t or "" for _, t, _ in brute.ODD)]:
        assert own.encode(t, allowed_special="all") == library.encode(t, add_special_tokens=False).ids


# LM scoring

def test_filter_reads_back_counts(spark):
    rng = np.random.default_rng(1)
    keys, counts = rng.integers(-2**62, 2**62, 3000), rng.integers(1, 5000, 3000)
    words = spark.createDataFrame([(int(k), int(c)) for k, c in zip(keys, counts)], "h long, c long")
    f = lm.build_filter(words, spark.createDataFrame([(5 << lm.TOP_BITS | 9, 100)], "k long, c long"))
    got = f.count(keys.view("u8"))
    assert (got >= lm.expected(lm.levels(counts))).all() and (got == lm.expected(lm.levels(counts))).mean() > 0.97
    assert f.count(lm.pair_key(np.array([5]), np.array([9])))[0] >= 81
    assert (f.count(rng.integers(0, 2**62, 5000).view("u8")) > 0).mean() < 0.03


@pytest.mark.parametrize("top", [lm.TOP, 40])
def test_base_scores_match_brute_force_and_the_model_beats_them(spark, top):
    docs = [(i, t) for i, t, _ in brute.documents()] + [(i, t) for i, t, _ in brute.ODD]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, c int")
    from pyspark.sql import functions as F

    from standlens.llm.langid import fold
    model, words = lm.fit(df, usable=fold(F.col("doc_id"), 7) != 2, top=top)
    out = lm.score(df, model, words).collect()
    want, n = brute.unigram(docs)
    assert model.tokens == n
    assert Counter((r.id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in out) == Counter(
        (i, a, b, round(c, 5)) for (i, _), (a, b, c) in zip(docs, want))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out)
    held = [r for r in out if brute.crc(r.id) % 7 == 2]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scoring_without_training_rows_and_empty_table(spark):
    from pyspark.sql import functions as F
    docs = brute.odd_docs(spark)
    model, words = lm.fit(docs, usable=F.lit(False))
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in lm.score(docs, model, words).collect())
    empty = brute.empty_docs(spark)
    assert lm.score(empty, *lm.fit(empty)).count() == 0


def test_model_holds_all_pairs_of_all_words_and_no_shard_outgrows_its_bits(spark):
    rng = random.Random(7)
    docs = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(200))) for i in range(300)]     # nearly all words and pairs occur once
    train = spark.createDataFrame(docs, "doc_id long, text string")
    model, words = lm.fit(train)
    scores = lambda rows: {r.id: r.score for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), model, words).collect()}
    seen, mixed = scores(docs), scores([(i, " ".join(rng.sample(t.split(), 200))) for i, t in docs])
    # a pair found once: p = (1 + one) / 2; the same words in another order: p = one / 2, but for the false positives
    one = 2 / model.denominator
    want = 200 * math.log10((1 + one) / 2) + math.log10((1 + 300 * one) / 600)      # the end token opens 300 texts
    assert all(abs(seen[i] - want) < 0.7 for i in seen)                              # a word or two are drawn twice
    assert sum(mixed.values()) < 0.95 * 300 * 200 * math.log10(one / 2)
    filled = [(np.unpackbits(np.frombuffer(r.bits, "u1")).mean()) for r in model.shards.collect()]
    assert sum(len(r.bits) * 8 for r in model.shards.collect()) >= lm.BITS_PER_ENTRY * 300 * 200 and max(filled) < 0.3


def test_query_keeps_no_table_that_its_result_does_not_read(spark, tmp_path, monkeypatch):
    import os
    folders, stored = {}, lm.stored

    def noted(df, name, *more):
        out = stored(df, name, *more)
        folders[name] = os.path.dirname(out.inputFiles()[0].removeprefix("file:").replace("///", "/"))
        return out

    monkeypatch.setattr(lm, "stored", noted)
    spark.createDataFrame([(i, f"a b c{i % 5} d") for i in range(40)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = lm.op5_lm_score(spark, str(tmp_path))
    assert {name for name, folder in folders.items() if os.path.isdir(folder)} == {"texts", "answers"}   # the filter and the words have gone
    assert len(folders) == 4 and len(out.collect()) == 40


def test_filter_follows_its_entries_without_a_cap():
    assert lm.size_of(400_000_000) >= lm.BITS_PER_ENTRY * 400_000_000


# BPE

def test_lexicon_is_minimal_and_exact():
    rules, rng = bpe.Merges(WORD), random.Random(6)
    words = {"".join(rng.choices("aben", k=rng.randint(1, 6))).encode() for _ in range(800)} | {"é".encode(), b"'s"}
    block = bpe.compile_lexicon({w: rules.merge(w) for w in words})
    lexicon = bpe.Lexicon(block)
    assert all(lexicon.get(w) == rules.merge(w) for w in words)
    probes = {"".join(rng.choices("aben", k=rng.randint(0, 7))).encode() for _ in range(3000)} - words
    assert all(lexicon.get(w) is None for w in probes)
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    rights = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert np.frombuffer(block, "<u4", 1)[0] == len(rights)       # one state per distinct continuation set
    # many at once are what they are one by one: held or not, of one byte, of the bound's length, beyond it, cut short, repeated
    more = [*words] + [w[:-1] for w in words if len(w) > 1] + [w + b"q" for w in words] + [b"a", b"\x00", b"ab" * 32, b"ab" * 33, b"e" * 300]
    assert lexicon.get_many(more) == [lexicon.get(w) for w in more]
    assert rules.merge_many(more) == [rules.merge(w) for w in more]
    assert lexicon.get_many([]) == rules.merge_many([]) == []
    empty = bpe.Lexicon(bpe.compile_lexicon({}))
    assert empty.get_many([b"a", b"ab" * 40]) == [None, None]
    assert empty.get(b"a") is None and empty.get(b"") is None


def test_words_at_hand_cost_one_lookup_and_no_collections():
    import gc
    rules, rng = bpe.Merges(WORD), random.Random(8)
    words = {"".join(rng.choices("abein", k=rng.randint(1, 70))) for _ in range(3000)} | {"é", "ab" * 40}
    known = bpe.Known(rules, bpe.Lexicon(bpe.compile_lexicon({w.encode(): rules.merge(w.encode()) for w in sorted(words)[:50]})))
    for own in (words, words | {"new", "é" * 40}):                # the second time nearly all are at hand
        got = known.of(own)
        for w in own:
            ids = rules.merge(w.encode())
            assert got[w] == (np.array(ids, "<u4").tobytes(), rules.decode(ids))
    assert all(len(w.encode()) <= bpe.MAX_WORD for w in known.young)
    assert rules.look_up(np.array([1, 2]), np.array([3, 4])).dtype.itemsize == 4     # ranks alone, half the bytes to look through
    ran, note = [], lambda phase, info: ran.append(phase)
    gc.callbacks.append(note)
    try:
        with bpe.uncollected():
            ran.clear()
            kept = [[i] for i in range(200_000)]
            inside = len(ran)
    finally:
        gc.callbacks.remove(note)
    assert inside == 0 and gc.isenabled() and len(kept) == 200_000


def test_bpe_equals_the_library(spark):
    docs = [(i, t) for i, t, _ in brute.documents()] + [(i, t) for i, t, _ in brute.ODD] + [
        (50, "ΑΣ ΟΔΟΣ. Σ İstanbul DON'T it'S we'RE ''s"), (51, "ẹ́ ḍ̇ \x1c\x1d   ﬁ Å"), (52, "!?" * 4000 + "ab" * 4000), (53, "a\U00011935\U00011930 ͸ ")]
    library = Tokenizer.from_file(WORD)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, decoded string")
    out = bpe.encode(df, WORD, bpe.build(df, WORD, limit=300))
    got = Counter((r.id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in out.collect())
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in docs]
    assert got == Counter((i, tuple(x), library.decode(x, skip_special_tokens=False)) for i, x in ids)
    back = bpe.decode(out.select("id", "ids", out.decoded.alias("was")), WORD)
    assert back.where("decoded != was").count() == 0
    empty = brute.empty_docs(spark)
    assert bpe.encode(empty, WORD, bpe.build(empty, WORD)).count() == 0


# pipeline

def test_pipeline_stages_against_brute_force(spark):
    import duckdb

    from standlens.llm import quality
    library = Tokenizer.from_file(BYTE)
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.stored(corpus_pipeline.quality_rules(spark, docs, brute.SF), "t")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{brute.SF}/documents.parquet'")
    want = con.sql("WITH " + quality.JUDGED_SQL.replace("{docs}", "documents") + " SELECT doc_id, cleaned FROM judged WHERE kept").fetchall()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert Counter(rows) == Counter(want) and kept.columns == columns
    lines = corpus_pipeline.stored(corpus_pipeline.line_dedup_stage(spark, kept, brute.SF), "t")
    assert Counter((r.doc_id, r.text, r.n_chars) for r in lines.collect()) == Counter((i, t, len(t)) for i, _, _, t in brute.line_dedup(rows))
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    single = corpus_pipeline.stored(corpus_pipeline.simhash_near_dedup(spark, lines, brute.SF), "t")
    classes = brute.simhash_classes([i for i, _ in rows], [brute.simhash(t) for _, t in rows])
    assert Counter(r.doc_id for r in single.collect()) == Counter(i for (i, _), c in zip(rows, classes) if i == c)
    rows = [(r.doc_id, r.text) for r in single.collect()]
    clean = corpus_pipeline.stored(corpus_pipeline.pii_redaction(spark, single, brute.SF), "t")
    votes = Counter((k, pii.votes(t, k, s, e)) for _, t in rows for part in pii.candidates(t) for k, s, e in part)
    model = pii.train(votes)
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter((i, pii.masked(t, pii.spans_of(t, model)[1])) for i, t in rows)
    assert not any(brute.pii(r.text) for r in clean.collect()) and clean.columns == columns
    packed = corpus_pipeline.pack(spark, clean, brute.SF).collect()
    tokens = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.collect()}
    total = Counter()
    for r in packed:
        total[r.doc_id] += r.length
    assert total == Counter(tokens)


def test_near_dedup_stage_keeps_one_row_of_each_group(spark):
    a, b, c = ("one text of some words that is not like the others", "quite another document about rivers and their banks", "a third thing altogether, on birds")
    rows = [(1, a), (1, a), (None, a), (2, b), (1, b), (None, c), (None, c), (None, c), (5, None), (5, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, rid string")
    out = corpus_pipeline.simhash_near_dedup(spark, docs, brute.SF)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(1, a), (1, b), (None, c), (5, None)])
    assert corpus_pipeline.simhash_near_dedup(spark, docs.limit(0), brute.SF).count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    for name, df in (("odd", brute.odd_docs(spark)), ("empty", brute.empty_docs(spark))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()} <= {i for i, _, _ in brute.ODD}
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_registered_queries():
    from standlens.llm import queries
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)
