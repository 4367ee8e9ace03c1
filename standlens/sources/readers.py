"""Readers for the stand, compartment and domain layers (SRC-01..03)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standlens.sources.schemas import COMPARTMENTS, DOMAIN, DOMAIN_LABELS, STANDS


def snake_case(name: str) -> str:
    """Normalise a column name to snake_case (camelCase, spaces, symbols)."""
    s = re.sub(r"([a-z])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^0-9a-zA-Z]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(df: DataFrame) -> DataFrame:
    """PRJ-01: every column name to snake_case; repeats get _2, _3, ..."""
    return df.toDF(*cleaned_names(df.columns))


def cleaned_names(names: list[str]) -> dict[str, str]:
    """Clean name -> name as delivered; repeats get _2, _3, ... as in ``clean_names``."""
    out: dict[str, str] = {}
    seen: dict[str, int] = {}
    for c in names:
        n = snake_case(c)
        seen[n] = seen.get(n, 0) + 1
        out[n if seen[n] == 1 else f"{n}_{seen[n]}"] = c
    return out


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Delivery:
    """Files of a layer that share a header."""

    example: str                  # one of them
    schema: T.StructType          # as it is in the file
    files: tuple[str, ...]        # files that no Spark job wrote
    jobs: tuple[str, ...]         # ids of the Spark jobs that wrote the others: all part files of one job have one header
    alone: bool                   # the layer's path is this very file


#: Part files of a Spark job carry its id.
JOB_ID = r"/part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$"
HEADERS_AT_ONCE = 8


def _literal_path(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _reader(spark: SparkSession, fmt: str) -> DataFrameReader:
    return (spark.read.option("header", True) if fmt == "csv" else spark.read).format(fmt)


def deliveries(spark: SparkSession, path: str, fmt: str = "parquet") -> list[Delivery]:
    """The files of a layer by their headers. Spark lists the files; one header is read for each Spark job that wrote some
    of them and for each file from elsewhere, some at a time, so a layer of very many part files costs few."""
    files = spark.read.format("binaryFile").load(path).select("path", F.regexp_extract("path", JOB_ID, 1).alias("job"))
    sources = (files.groupBy("job", F.when(F.col("job") == "", F.col("path")).alias("file"))
               .agg(F.min("path").alias("example"), F.count(F.lit(1)).alias("n")).orderBy("example").collect())
    if not sources:
        raise ValueError(f"{path}: no files")
    last, name = path.rstrip("/").rpartition("/")[2], sources[0].example.rpartition("/")[2]
    alone = len(sources) == 1 and sources[0].n == 1 and last in (name, _literal_path(name))
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda s: header(spark, s.example, fmt), sources))
    found: dict[str, list[int]] = {}
    for i, schema in enumerate(schemas):
        found.setdefault(schema.json(), []).append(i)
    return [Delivery(sources[own[0]].example, schemas[own[0]], tuple(sources[i].example for i in own if not sources[i].job),
                     tuple(sources[i].job for i in own if sources[i].job), alone) for own in found.values()]


def header(spark: SparkSession, file: str, fmt: str) -> T.StructType:
    return _reader(spark, fmt).load(_literal_path(file)).schema


def _delivered(spark: SparkSession, path: str, fmt: str, d: Delivery) -> list[DataFrame]:
    reader = _reader(spark, fmt).schema(d.schema)
    if d.alone:
        return [reader.load(path)]
    out = []
    if d.files:
        out.append(reader.option("basePath", path).load([_literal_path(f) for f in d.files]))
    if d.jobs:
        names = "{" + ",".join(f"part-*-{j}*" for j in d.jobs) + "}"
        out.append(_reader(spark, fmt).schema(d.schema).option("pathGlobFilter", names).load(path))
    return out


def input_position(fmt: str) -> tuple[Column, Column, Column]:
    """Three columns that order the rows of a layer as they stand in its files. A text file has no row numbers: there the rows
    of a split follow its start, and Spark's row ids rise inside a split."""
    if fmt == "parquet":
        return F.col("_metadata.file_path"), F.col("_metadata.row_index"), F.lit(0)
    return F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()


def read_layer(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", geometry: bool = False,
               optional: Sequence[str] = (), input_order: bool = False) -> DataFrame:
    """A layer by the names it is delivered with, file by file: the names of each file are cleaned, matched to the schema and
    cast to its types, whatever their spelling, order and types in the other files. A file without a column is an error unless the
    column is ``optional`` (then it is null there). ``geometry`` passes the geometry column through, if there is one, as the
    opaque bytes it holds. ``input_order`` adds tb1..tb3, the rows' order in the files."""
    parts = []
    shape: T.DataType | None = None
    for d in deliveries(spark, path, fmt):
        for df in _delivered(spark, path, fmt, d):
            given = cleaned_names(df.columns)
            missing = [f.name for f in schema.fields if f.name not in given and f.name not in optional]
            if missing:
                raise ValueError(f"{d.example}: no column for {', '.join(missing)}; it has {', '.join(df.columns)}")
            cols = [(_quoted(given[f.name]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
            at = next((given[n] for n in GEOMETRY_NAMES if n in given), None) if geometry else None
            if at is not None:
                cols.append(_quoted(at).alias("geometry"))
                shape = shape or df.schema[at].dataType
            if input_order:
                cols += [c.alias(n) for c, n in zip(input_position(fmt), ("tb1", "tb2", "tb3"))]
            parts.append(df.select(*cols))
    if shape is not None:
        parts = [p.withColumn("geometry", (F.col("geometry") if "geometry" in p.columns else F.lit(None)).cast(shape)) if len(parts) > 1 else p
                 for p in parts]
    return reduce(DataFrame.unionByName, parts)


# ---- fixed values: cleaned names of a geometry column, and columns a stand layer may lack ----
GEOMETRY_NAMES = ("geometry", "shape", "geom", "wkb_geometry")
OPTIONAL_STANDS = ("created_date",)
# ---- end of fixed values ----


def read_stands(spark: SparkSession, path: str, geometry: bool = False, fmt: str = "parquet", input_order: bool = False) -> DataFrame:
    """SRC-01: the whole stand layer."""
    return read_layer(spark, path, STANDS, fmt, geometry, OPTIONAL_STANDS, input_order)


def read_compartments(spark: SparkSession, path: str, geometry: bool = False, fmt: str = "parquet", input_order: bool = False) -> DataFrame:
    """SRC-02: the compartment (management unit) layer."""
    return read_layer(spark, path, COMPARTMENTS, fmt, geometry, (), input_order)


def read_domains(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> dict[str, DataFrame]:
    """SRC-03: code -> label tables, one per domain, read by the names in their headers (``code`` and ``label``, in any
    order) with the label renamed per domain; ``input_order`` orders the rows as they stand in the files, file after file."""
    out = {}
    for name, path in paths.items():
        df = read_layer(spark, path, DOMAIN, fmt, input_order=True)
        order = F.struct(F.col("tb1").alias("file"), F.col("tb2").alias("at"), F.col("tb3").cast("long").alias("row"))
        out[name] = (df.withColumn("input_order", order).drop("tb1", "tb2", "tb3")
                       .withColumnRenamed("label", DOMAIN_LABELS.get(name, "label")))
    return out
