"""Quality rules, line first (operator 6). DataFrame functions only.

Every line is judged by itself: punctuation, shouting, navigation and boilerplate rules. Failing lines
are removed; a document that loses more than ``max_loss`` of its word characters is rejected, and so is
one that fails the document counts (too few words, too many words in repeated 5-word windows).

Everything is computed inside one row, so there is no shuffle and no key that could be hot. Defined
cases: a null text has no words and is rejected (``n_words`` 0); an empty or blank text likewise; a
line without words is never removed; rows are judged one by one, so repeated rows get equal verdicts;
an empty table gives an empty table; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CLASS, col, fresh, let

SYMBOLS = r"[#*$%&|<>]"
#: Phrases of site furniture; a short line that holds one is boilerplate.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript",
    "javascript is disabled", "privacy policy", "read more", "sign up for our newsletter",
    "skip to content", "subscribe to our newsletter", "terms of service", "terms of use", "uses cookies",
)
BOILERPLATE_RX = "(?i)(" + "|".join(BOILERPLATE) + ")"
#: A separator that stands alone between menu entries.
NAV_RX = r"(?<![^\x20\x09-\x0D])[|>/»›•·](?![^\x20\x09-\x0D])"

WINDOW = 5


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the array (first occurrences included).

    Windows are compared by a 64-bit hash. Texts without a repeated window, nearly all, stop at the
    distinct count; only the others sort their windows and add up the union of the covered words.
    """
    w = WINDOW

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - w),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(w)]))

    def covered(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            hit = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
            return F.sort_array(F.transform(hit, lambda x: x["i"]))

        def union(p: Column) -> Column:
            gaps = F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(w)), F.lit(w)))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        return let(let(pairs, starts), union)

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(covered(found))

    hashed = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) < w, F.lit(0).cast("long")).otherwise(let(let(hashed, windows), count))


def line_fails(line: Column) -> Column:
    """True if a line with words fails a rule.

    punctuation: symbols make up over a sixth of it, or no letter or digit is in it, or 40 words and
    more go without one mark; shouting: 3 exclamation marks and more, at half of the words; navigation:
    3 lone separators and more, at a fifth of the words; stutter: a third of 6 words and more repeats the
    word before; boilerplate: a phrase of site furniture in at
    most 12 words.
    """
    def rules(words: Column) -> Column:
        n = F.size(words)
        symbols = F.regexp_count(line, F.lit(SYMBOLS))
        shouts = F.regexp_count(line, F.lit("!"))
        seps = F.regexp_count(line, F.lit(NAV_RX))
        twice = F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1)))
        return (n > 0) & (
            (symbols * 6 > F.char_length(line))
            | ((shouts >= 3) & (shouts * 2 >= n))
            | ((seps >= 3) & (seps * 5 >= n))
            | ((n >= 6) & (twice * 3 >= n))
            | ~line.rlike(r"[\p{L}\p{N}]")
            | ((n >= 40) & ~line.rlike(r"[.,;:!?…。，、！？؟।]"))
            | ((n <= 12) & line.rlike(BOILERPLATE_RX)))

    return let(F.filter(F.split(line, SPACE_CLASS + "+"), lambda w: w != ""), rules)


def word_chars_of(c: Column) -> Column:
    return F.char_length(F.regexp_replace(c, SPACE_CLASS + "+", "")).cast("long")


def judged(docs: DataFrame, text_col: str = "text", max_loss: float = 0.3, min_words: int = 10,
           max_repeat_pct: int = 20) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_removed,
    base_failed, kept and cleaned_text (null for a null text). A column of ``docs`` that has one of these
    names is replaced."""
    text = col(docs, text_col)
    t, words, lines, keep = fresh(docs, "__q_text", "__q_words", "__q_lines", "__q_keep")
    out = docs.withColumn(t, F.coalesce(text, F.lit("")))
    out = out.withColumns({
        words: F.filter(F.split(F.col(t), SPACE_CLASS + "+"), lambda w: w != ""),
        lines: F.split(F.col(t), "\n"),
    })
    out = out.withColumn(keep, F.filter(F.col(lines), lambda x: ~line_fails(x)))
    with_words = F.filter(F.col(lines), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    repeats, dup = fresh(docs, "__q_rep", "__q_dup")
    out = out.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.array_join(F.col(words), "")).cast("long"),
        "n_symbols": F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(with_words, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "n_repeat_words": repeated_words(F.col(words)).cast("long"),
        "n_lines_removed": (F.size(lines) - F.size(keep)).cast("long"),
        "cleaned_text": F.when(F.col(t).isNotNull(), F.array_join(F.col(keep), "\n")),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < min_words)
                         | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))
    lost = F.when(F.col("n_lines_removed") == 0, F.lit(0).cast("long")).otherwise(
        F.col("word_chars") - word_chars_of(F.col("cleaned_text")))
    out = out.withColumn("kept", ~F.col("base_failed") & (lost <= F.lit(max_loss) * F.col("word_chars")))
    out = out.withColumn("cleaned_text", F.when(text.isNull(), F.lit(None).cast("string")).otherwise(F.col("cleaned_text")))
    return out.drop(t, words, lines, keep, repeats, dup)


def clean(docs: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The documents kept, with failing lines taken out of their text; the columns of ``docs``."""
    names = docs.columns
    marked = judged(docs.select([col(docs, c).alias(f"c{i}") for i, c in enumerate(names)]),
                    f"c{names.index(text_col)}", **kw)
    # a generator, not a filter: a filter would be pushed below the cleaned text and judge every line once more
    kept = F.explode(F.when(F.col("kept"), F.array("cleaned_text"))).alias("cleaned")
    out = marked.select(*[f"c{i}" for i in range(len(names))], kept)
    return out.select([F.col("cleaned" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(names)])


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

#: DuckDB: the same rules as relations over words and lines.
JUDGED_SQL = r"""
j_docs AS (SELECT row_number() OVER () AS rid, * , coalesce(text, '') AS t FROM {docs}),
j_words AS (SELECT rid, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM j_docs),
j_win AS (SELECT rid, unnest(range(1, greatest(len(w) - 3, 1))) AS i, w FROM j_words WHERE len(w) >= 5),
j_grams AS (SELECT rid, i, array_to_string(w[i:i+4], ' ') AS g FROM j_win),
j_rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM j_grams) WHERE c > 1),
j_cov AS (SELECT rid, sum(least(coalesce(nxt - i, 5), 5)) AS n FROM
          (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM j_rep) GROUP BY rid),
j_lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM j_docs),
j_lw AS (SELECT *, [x FOR x IN regexp_split_to_array(line, '[\x20\x09-\x0D]+') IF x <> ''] AS lw FROM j_lines),
j_facts AS (SELECT rid, line, k, len(lw) AS n, len([i FOR i IN range(2, len(lw) + 1) IF lw[i] = lw[i - 1]]) AS twice,
            len(regexp_extract_all(line, '[#*$%&|<>]')) AS sym,
            len(line) - len(replace(line, '!', '')) AS ex,
            len([x FOR x IN lw IF x IN ('|', '>', '/', '»', '›', '•', '·')]) AS seps
            FROM j_lw),
j_fail AS (SELECT *, n > 0 AND (sym * 6 > len(line) OR (ex >= 3 AND ex * 2 >= n) OR (seps >= 3 AND seps * 5 >= n) OR (n >= 6 AND twice * 3 >= n)
            OR NOT regexp_matches(line, '[\p{L}\p{N}]') OR (n >= 40 AND NOT regexp_matches(line, '[.,;:!?…。，、！？؟।]'))
            OR (n <= 12 AND regexp_matches(line, '{boiler}'))) AS bad FROM j_facts),
j_sum AS (SELECT rid, count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS dup,
          sum(len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (WHERE bad) AS lost,
          string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT bad) AS cleaned FROM j_fail GROUP BY rid),
j_base AS (SELECT d.*, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines,
           coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost, coalesce(cleaned, '') AS cleaned
           FROM j_docs d JOIN j_words USING (rid) JOIN j_sum USING (rid) LEFT JOIN j_cov c USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost <= 0.3 * word_chars AS kept FROM j_base)
""".replace("{boiler}", BOILERPLATE_RX)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judged(docs).select(COLUMNS)


OP6_SQL = "WITH " + JUDGED_SQL.replace("{docs}", "documents") + " SELECT " + ", ".join(COLUMNS) + " FROM judged"
