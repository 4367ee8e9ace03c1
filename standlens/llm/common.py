"""Helpers shared by the operators: tables kept in the shared folder, row keys, Arrow batches."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from standlens.session import checkpoint_dir

#: Fixed value: the white space of the contracts, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder (``spark.checkpoint.dir``) and read it back: lineage is cut,
    and a lost executor costs no recomputation of what was written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of shuffles that nothing refers to any more, such as those behind a table that has been ``stored``: Spark deletes
    their files once the driver's collectors, Python's first, have run, which they may otherwise not do for a long time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Hand a copy of this package to the Python workers, once a session: they may not find it otherwise."""
    sc = spark.sparkContext
    if getattr(sc, "_standlens_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    own = tempfile.mkdtemp(prefix="standlens-ship-")      # Spark serves the file from here as long as the session lives
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    archive = os.path.join(own, "standlens-llm.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._standlens_shipped = True


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with this package at the workers' hands."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def col(df: DataFrame, name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return df["`" + name.replace("`", "``") + "`"]


def fold_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else; equal outputs mean equal inputs up to the case of A-Z.

    The UTF-8 bytes are read as Latin-1 characters, so ``lower`` also moves lead bytes C0-DE to E0-FE.
    That stays one-to-one: the number of continuation bytes that follow still tells the two apart.
    The result is a comparison key, not text.
    """
    return F.lower(F.decode(F.encode(c, "UTF-8"), "ISO-8859-1"))


def key128(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of the same values under different seeds."""
    return F.xxhash64(*cols), F.xxhash64(F.lit("#"), *cols)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def slices(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to about ``limit`` bytes (one row at least), so that Python objects made of
    one slice stay small whatever the batch size."""
    for b in batches:
        if not b.num_rows:
            continue
        step = max(1, int(b.num_rows * limit / max(1, b.nbytes)))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def commonest(counts: DataFrame, n_col: str, limit: int) -> DataFrame:
    """The rows of a count table from some count on, as many as fit ``limit``: the cut is read off a histogram of
    the counts' logarithms (at most some thousand bins, whatever the data), so no task sorts or gathers the rows themselves."""
    bin_of = F.floor(F.ln(n_col) * 50)
    bins = sorted(counts.groupBy(bin_of.alias("b")).count().collect(), key=lambda r: -r.b)
    cut, total = None, 0
    for r in bins:
        total += r["count"]
        if total > limit:
            break
        cut = r.b
    return counts.where(bin_of >= cut) if cut is not None else counts.limit(0)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes: what bytes.split() splits on is that very class."""
    return text.split()


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _term_table() -> bytes:
    keep = set(range(0x30, 0x3A)) | set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
    return bytes(bytes([i]).lower()[0] if i in keep else 0x20 for i in range(256))


#: Bytes of terms (digits, ASCII letters, everything beyond ASCII) stay, A-Z lower-cased; every other byte becomes a blank.
TERMS = _term_table()


def term_pieces(text: bytes, limit: int = 1 << 20) -> Iterator[bytes]:
    """The terms of UTF-8 bytes between blanks, a blank at both ends, in pieces of about ``limit`` bytes that meet at a blank."""
    t = b" " + text.translate(TERMS) + b" "
    at = 0
    while at < len(t) - 1:
        end = t.find(b" ", at + limit)
        end = len(t) - 1 if end < 0 else end
        yield t[at:end + 1]
        at = end


def best_rows(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str, spread: str, salts: int = 64) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, numbered by ``rank`` from 1. First the best of each (key, salt), the salt
    a hash of ``spread``, then the best of these: a key with very many rows is no single group."""
    (salt,) = fresh(df, "salt")
    part = df.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)))
    near = Window.partitionBy(*keys, salt).orderBy(*order)
    part = part.withColumn(rank, F.row_number().over(near)).where(F.col(rank) <= k)
    far = Window.partitionBy(*keys).orderBy(*order)
    return part.withColumn(rank, F.row_number().over(far)).where(F.col(rank) <= k).drop(salt)
