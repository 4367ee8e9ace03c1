r"""Line dedup (operator 7). DataFrame functions only.

Lines become 128-bit key hashes. The occurrences are range-partitioned by (key, salt), the salt taken
from the document, and sorted inside a partition by document and position, so one streaming window marks
first occurrences: of the key in a document, and of the key at all. A line that sits in a third of
all documents is thereby spread over 64 groups; what meets per key afterwards is at most one row
per salt. The verdicts come back as one row per document: the lines kept, as a run-length compressed
bitmap (start, length), never as text. ``apply`` cuts the texts by these runs.

A document is one distinct (id, text) pair. Defined cases: a null or empty text is one empty line; null
ids are ordinary values; rows equal in id and text count as one document and get equal results; ties
between documents go to the smaller id (nulls first), then the smaller row key; an empty table gives an
empty table; columns of other names are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, col, fold_ascii, fresh, key128, n_partitions

#: Groups that the documents of one key are dealt to; one bit of a long each.
SALTS = 64
RUNS = "array<struct<start:int,len:int>>"


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    text = col(docs, text_col)
    return key128(F.coalesce(text, F.lit("")), col(docs, id_col).isNull(), col(docs, id_col))


def bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
            min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(r1, r2, n_dropped, kept): for each document that loses lines, its row key and the runs kept.

    A line goes if its key (trimmed, A-Z lower-cased) has at least ``min_chars`` code points and is found in
    at least ``min_docs`` documents; with ``keep_first`` the first occurrence of all stays.
    """
    r1, r2 = row_keys(docs, id_col, text_col)
    lines = docs.select(r1.alias("r1"), r2.alias("r2"), col(docs, id_col).alias("id"),
                        F.posexplode(F.split(F.coalesce(col(docs, text_col), F.lit("")), "\n")).alias("pos", "line"))
    trimmed = F.btrim(F.col("line"), F.lit(SPACE))
    k1, k2 = key128(fold_ascii(trimmed))
    occ = (lines.where(F.char_length(trimmed) >= min_chars)
           .select(k1.alias("k1"), k2.alias("k2"), F.pmod("r1", F.lit(SALTS)).cast("int").alias("salt"),
                   "id", "r1", "r2", "pos"))
    group = ["k1", "k2", "salt"]
    order = Window.partitionBy(*group).orderBy("id", "r1", "r2", "pos")
    before = F.lag(F.struct("r1", "r2")).over(order)
    marked = (occ.repartitionByRange(n_partitions(docs.sparkSession), *group)
              .select("*", (before.isNull() | (before != F.struct("r1", "r2"))).alias("opens")))
    first = F.min(F.struct("id", "r1", "r2", "pos"))
    per_salt = marked.groupBy(group).agg(F.count_if("opens").alias("n"), first.alias("first"))
    # one row per key and salt at most: the sum is partial before its shuffle; bit s tells that salt s has the key
    seen = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt")))
    per_key = (per_salt.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.min("first").alias("first"), seen.alias("seen"))
               .where(F.col("n") >= min_docs))
    salts_of = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)),
                        lambda x: F.call_function("shiftright", F.col("seen"), x).bitwiseAND(F.lit(1)) == 1)
    gone = per_key.select("k1", "k2", "first", F.explode(salts_of).alias("salt"))
    drops = occ.join(gone, group)
    if keep_first:
        drops = drops.where(F.struct("id", "r1", "r2", "pos") != F.col("first"))
    per_doc = drops.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    # from the sorted dropped positions to the runs between them; the last run is open-ended (len -1)
    p = F.col("p")
    runs = F.transform(F.sequence(F.lit(0), F.size(p)), lambda i: F.struct(
        F.coalesce(F.get(p, i - 1) + 1, F.lit(0)).alias("start"),
        F.coalesce(F.get(p, i) - F.coalesce(F.get(p, i - 1) + 1, F.lit(0)), F.lit(-1)).alias("len")))
    return per_doc.select("r1", "r2", F.size(p).cast("long").alias("n_dropped"),
                          F.filter(runs, lambda x: x["len"] != 0).cast(RUNS).alias("kept"))


def apply(docs: DataFrame, maps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text (columns of these names are replaced); the only
    shuffle of whole texts."""
    r1, r2, m1, m2, runs, n, lines = fresh(docs, "__l_r1", "__l_r2", "__l_m1", "__l_m2", "__l_runs", "__l_n", "__l_lines")
    k1, k2 = row_keys(docs, id_col, text_col)
    text = F.coalesce(F.col("`" + text_col.replace("`", "``") + "`"), F.lit(""))
    maps = maps.select(F.col("r1").alias(m1), F.col("r2").alias(m2), F.col("n_dropped").alias(n), F.col("kept").alias(runs))
    out = docs.withColumns({r1: k1, r2: k2})
    out = out.join(maps, (out[r1] == maps[m1]) & (out[r2] == maps[m2]), "left").withColumn(lines, F.split(text, "\n"))
    cut = F.flatten(F.transform(F.col(runs), lambda x: F.slice(
        F.col(lines), x["start"] + 1, F.when(x["len"] < 0, F.size(lines) - x["start"]).otherwise(x["len"]))))
    out = out.withColumns({
        "n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce(F.col(n), F.lit(0).cast("long")),
        "kept_text": F.when(F.col(runs).isNull(), text).otherwise(F.array_join(cut, "\n"))})
    return out.drop(r1, r2, m1, m2, runs, n, lines)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with the dropped lines taken out of the texts; the columns of ``docs``, a null text stays null."""
    names = docs.columns
    plain = docs.select([col(docs, c).alias(f"c{i}") for i, c in enumerate(names)])
    own = {"id_col": f"c{names.index(id_col)}", "text_col": f"c{names.index(text_col)}"}
    out = apply(plain, bitmaps(plain, **own, **kw), **own)
    new = F.when(F.col(own["text_col"]).isNotNull(), F.col("kept_text"))
    return out.select([(new if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = apply(docs, bitmaps(docs, min_docs=10, min_chars=1))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


#: DuckDB: lower() there folds more than A-Z, so the folding is spelt out by translate().
DEDUP_SQL = r"""
l_docs AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS lt FROM {docs}),
l_lines AS (SELECT rid, unnest(string_split(lt, chr(10))) AS line, generate_subscripts(string_split(lt, chr(10)), 1) AS k FROM l_docs),
l_keys AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l_lines),
l_gone AS (SELECT key FROM l_keys WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
l_marked AS (SELECT l_keys.*, l_gone.key IS NOT NULL AS gone FROM l_keys LEFT JOIN l_gone USING (key)),
l_sum AS (SELECT rid, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
          coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS kept_text FROM l_marked GROUP BY rid),
deduped AS (SELECT d.* EXCLUDE (lt), s.n_lines, s.n_dropped, s.kept_text FROM l_docs d JOIN l_sum s USING (rid))
"""

OP7_SQL = "WITH " + DEDUP_SQL.replace("{docs}", "documents") + \
    " SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM deduped"
