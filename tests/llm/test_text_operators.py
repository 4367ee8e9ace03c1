"""Quality rules, line dedup, SimHash, PII, language ID: brute force, odd rows, empty tables."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from standlens.llm import langid, line_dedup, pii, quality, simhash

from . import brute


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# quality rules

def test_quality_counts_match_brute_force(spark):
    docs = [(i, t) for i, t, _ in brute.documents()] + [(i, t) for i, t, _ in brute.ODD]
    repeated = [(100_000 + k, " ".join(random.Random(k).choices("ab cd ef gh".split(), k=60))) for k in range(30)]
    docs += repeated
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.judged(df).collect())
    assert got == Counter((i, *brute.quality_base(t)) for i, t in docs)


@pytest.mark.parametrize("line,fails", [
    ("A plain sentence.", False), ("Heading without a stop", False), ("", False), ("a | b | c | d | e", True), ("Home > News > Local > Today", True),
    ("WOW!!! BUY!!! NOW!!!", True), ("Really! Yes! It was a long way to the river, and we went!", False), ("*** ### $$$", True), ("---", True),
    ("All rights reserved.", True), ("The court said that all rights reserved by the treaty remain with those who signed it in May.", False),
    ("one " * 5, False), ("la la ouque ouque les les", True), ("It had had a very very long day, they said, and so it was.", False),
    ("w x " * 30, True), ("x = a[1] * 2", False),
])
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(quality.line_fails(F.col("line"))).first()[0] is fails


def test_quality_rejects_what_loses_too_much_and_cleans_the_rest(spark):
    good = "This is a good sentence with many words in it. " * 3
    rows = [(1, good.replace(". ", ", ", 1) + "\nHome | About | News | Shop"), (2, "Home | About | News | Shop | Cart | Help | More\n" * 5 + "One good line here."), (3, None)]
    out = {r.doc_id: r for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "Home" not in out[1].cleaned_text and out[1].n_lines_removed == 1
    assert not out[2].kept and not out[3].kept and out[3].cleaned_text is None


def test_quality_odd_rows_and_clashing_columns(spark):
    docs = brute.odd_docs(spark)
    out = quality.clean(docs)
    assert out.columns == docs.columns and out.schema["n_lines"].dataType.simpleString() == "string"
    assert {r.doc_id for r in out.collect()} <= {i for i, _, _ in brute.ODD}
    assert quality.judged(docs).count() == len(brute.ODD)
    assert quality.clean(brute.empty_docs(spark)).count() == 0


# line dedup

def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(4)
    lines = ["Same line.", "SAME line. ", "Ünder É", "ünder É", "other", "", "  ", "\ttab\x0b"] + [f"line {k}" for k in range(40)]
    docs = [(k, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for k in range(300)] + [(i, t) for i, t, _ in brute.ODD]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = line_dedup.apply(df, line_dedup.bitmaps(df, min_docs=10))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()) == Counter(brute.line_dedup(docs))


def test_line_dedup_keeps_first_occurrences(spark):
    docs = [(3, "a b\nx"), (1, "y\nA B\na b"), (2, "a b\nz"), (None, "q")]
    out = line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string"), min_docs=2, keep_first=True)
    assert {r.doc_id: r.text for r in out.collect()} == {3: "x", 1: "y\nA B", 2: "z", None: "q"}


def test_line_dedup_runs_are_compressed_bitmaps(spark):
    docs = [(k, "\n".join(["u%d" % k, "hot", "hot", "v%d" % k, "w%d" % k])) for k in range(10)]
    maps = line_dedup.bitmaps(spark.createDataFrame(docs, "doc_id long, text string"), min_docs=10).collect()
    assert len(maps) == 10 and all(r.n_dropped == 2 and [tuple(x) for x in r.kept] == [(0, 1), (3, -1)] for r in maps)


def test_line_dedup_odd_rows_and_empty_table(spark):
    docs = brute.odd_docs(spark)
    out = line_dedup.dedup(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((i, t) for i, t, _ in brute.ODD)
    assert line_dedup.dedup(brute.empty_docs(spark)).count() == 0


def test_native_operators_run_no_python(spark):
    docs = brute.odd_docs(spark).select("doc_id", "text")
    for df in (quality.judged(docs), line_dedup.apply(docs, line_dedup.bitmaps(docs))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|MapInArrow|CartesianProduct|NestedLoop", plan)


# SimHash

@pytest.mark.parametrize("crowd", [1024, 0])
def test_simhash_matches_brute_force(spark, crowd):
    docs = [(i, t) for i, t, _ in brute.documents()] + [(i, t) for i, t, _ in brute.ODD if t != brute.LONG]
    fps = [brute.simhash(t) for _, t in docs]
    want = Counter(zip([i for i, _ in docs], fps, brute.simhash_classes([i for i, _ in docs], fps)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r.id, r.fp % 2**64, r.component_id) for r in simhash.classes(df, crowd=crowd).collect())
    assert got == want


def test_links_connect_a_ball_of_fingerprints(spark):
    rng = random.Random(1)
    fps = {0}
    for _ in range(400):
        x = rng.choice(sorted(fps))
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps) + [rng.getrandbits(64) for _ in range(50)]
    want = brute.simhash_classes(list(range(len(fps))), fps)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    for crowd in (1024, 2):
        roots = {r.v: r.root for r in simhash.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, crowd)).collect()}
        got = {}
        for k, x in enumerate(signed):
            got.setdefault(roots.get(x, x), []).append(k)
        assert sorted(map(tuple, got.values())) == sorted(
            {tuple(k for k, c in enumerate(want) if c == d) for d in set(want)})


def test_simhash_dedup_keeps_one_of_each_class(spark):
    docs = brute.odd_docs(spark)
    out = simhash.dedup(docs)
    assert out.columns == docs.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[1] == 2 and ids[None] == 2 and ids[2] == 1 and 3 not in ids and 4 not in ids      # 2, 3, 4 are all empty
    assert simhash.dedup(brute.empty_docs(spark)).count() == 0


# PII

def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        s = "".join(rng.choice("ab@@..-_%+ 0123456789 1255()\n") for _ in range(rng.randint(0, 60)))
        assert [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(s)[0]] == brute.pii(s), s


def test_model_learns_that_checksums_and_cues_matter():
    model = pii.train(Counter({("card", (1, 1, 1, 0, 0, 0)): 500, ("card", (1, -1, 1, 0, 0, 0)): 500, ("card", (1, -1, -1, 0, -1, 0)): 200}))
    assert model.score("card", (1, 1, 1, 0, 0, 0)) > 0.9 > 0.5 > model.score("card", (1, -1, 1, 0, 0, 0))
    text = "She was born on 12.03.1980; the release of 12.03.1980 was late. My SSN is 123-45-6789, version 123-45-6789x."
    base, spans = pii.spans_of(text, pii.train(Counter()))
    assert base == [] and [(k, text[a:b]) for k, a, b in spans] == [("birthdate", "12.03.1980"), ("ssn", "123-45-6789")]


def test_pii_matches_brute_force_and_keeps_base_spans(spark):
    docs = [(i, t) for i, t, _ in brute.documents()] + [(i, t) for i, t, _ in brute.ODD]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    show = lambda spans: [f"{x['kind']}:{x['start']}:{x['end']}" for x in spans]
    out = rows_of(pii.detect(df, pii.fit(df)))
    assert Counter((r["id"], tuple(show(r["base"]))) for r in out) == Counter((i, tuple(brute.pii(t))) for i, t in docs)
    assert all(set(show(r["base"])) <= set(show(r["spans"])) for r in out)


def test_pii_redacts_and_handles_odd_rows(spark):
    docs = brute.odd_docs(spark)
    out = pii.redact(docs, pii.fit(docs))
    assert out.columns == docs.columns
    texts = [r.text for r in out.where("doc_id = 8").collect()]
    assert texts == ["Mail [EMAIL] or call [PHONE], server [IP], card [CARD]."]
    assert out.where("text IS NULL").count() == 2
    empty = brute.empty_docs(spark)
    assert pii.detect(empty, pii.fit(empty)).count() == 0


# language ID

def test_language_id_learns_from_the_training_fold_only(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    model = langid.fit(docs, usable=langid.fold(F.col("doc_id"), 3) != 1, per_label=60)
    out = langid.predict(docs, model).join(docs.withColumnRenamed("doc_id", "id").select("id", "lang"), "id").collect()
    held = [r for r in out if brute.crc(r.id) % 3 == 1]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_id_odd_rows(spark):
    docs = brute.odd_docs(spark)
    model = langid.fit(docs)
    assert model.labels == ["en", "fr"]
    out = langid.predict(docs, model).collect()
    assert len(out) == len(brute.ODD)
    assert all(r.lang_pred == "und" and r.score == 0 and not r.accepted for r in out if r.id in (2, 3, 4))
    empty = brute.empty_docs(spark)
    assert langid.fit(empty).labels == [] and langid.predict(empty, langid.fit(empty)).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}


def test_long_texts_count_like_short_ones():
    text = "abc déf " * 300_000
    assert abs(langid.counts(text).sum() - langid.counts("abc déf ").sum() * 300_000) < 300_000 * 4


# against DuckDB

@pytest.mark.parametrize("name", ["op6_quality_rules", "op7_line_dedup"])
def test_native_queries_match_their_sql(spark, name):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))
    from check_oracle import compare, duck

    from standlens.llm import queries
    ok, _, _, msg = compare(spark, duck(brute.SF), name, queries.queries()[name], queries.oracle_sql()[name], brute.SF)
    assert ok, msg
