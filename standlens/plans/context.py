"""The shared pipeline: decoded stand records, working sets, screened and
dated tables and snapshots, for the division and the department scope.

Everything here is a lazy DataFrame; nothing is collected. A ``Context``
can instead be built over a prepared department set written to the shared
checkpoint folder (SRC-04/05), partitioned by authority so the division is
a partition-pruned read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from standlens.config import Params
from standlens.functions.classes import project_cover_class
from standlens.functions.codes import parent_code
from standlens.functions.labels import missing_as
from standlens.operators import lookup as lk
from standlens.operators.dedup import first_per_key
from standlens.operators.snapshots import TIE_BREAK, add_inventory_years, latest_per_stand, stand_year_dedup, with_next_year
from standlens.sources.fixture import Inputs, tpch_inputs

DIVISION = "division"
DEPARTMENT = "department"
#: Records of one stand that a task may be given whole.
HOT_STAND = 1_000_000


def add_project_class(df: DataFrame, p: Params) -> DataFrame:
    """PRJ-10 as a transform: adds cover_code_chr and project_cover_class."""
    return (df.withColumn("cover_code_chr", F.col("l4covertype_full").cast("string"))
              .withColumn("project_cover_class", project_cover_class("l4covertype_full", "l3cover_key", p)))


def cover_screen(df: DataFrame) -> DataFrame:
    """FLT-02: drop null L3 label and L3 code 0 (null code drops too)."""
    return df.filter(F.col("l3cover_key").isNotNull() & (F.col("l3covertype") != 0))


class Scope:
    """Screened, dated and snapshot tables of one scope (E3)."""

    def __init__(self, ctx: "Context", working: DataFrame, name: str):
        self.ctx, self.working, self.name = ctx, working, name
        self.p = ctx.p
        self._stored: dict[str, DataFrame] = {}

    def materialize(self, base_path: str, buckets: int | None = None, hot: int = HOT_STAND,
                    columns: Sequence[str] | None = None) -> dict[str, str]:
        """Write the stand-year table once (SRC-06 style hand-off) and read it back, so the many summaries built on it scan a table
        instead of re-running the dedup. The folder should be the shared ``spark.checkpoint.dir``. ``buckets``: choose so
        many that one holds a few hundred MB; a bucketed read is not split further (default: the session's shuffle partitions).

        The records move once, by their stand: that serves the window by stand and year, the window that finds the stand's
        next year, and the buckets of the written table. A record's next year is stored, so the interval snapshot needs no window, and
        records without one, the latest of their stand, have a folder of their own: the latest snapshot is a pruned read.
        Where one stand has more than ``hot`` records, they are first reduced to one a year by a shuffle on stand and year, which
        prunes before it, as no task should get them all. ``columns``: what the readers use, where that is not all."""
        spark = self.ctx.spark
        path = f"{base_path}/{self.name}_dedup"
        table = self._table = f"standlens_{self.name}_dedup_{hashlib.sha256(base_path.encode()).hexdigest()}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")      # of an earlier run into the same folder; the files are not Spark's to drop
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        timed = self.timed
        if columns is not None:
            keep = {*columns, "fcskey", "date", "inventory_year_raw", *TIE_BREAK}
            timed = timed.select(*[c for c in timed.columns if c in keep])
        most = timed.groupBy("fcskey").count().agg(F.max("count")).first()[0] or 0
        rows = (stand_year_dedup(timed) if most > hot else timed).repartition(buckets, "fcskey")
        stored = with_next_year(stand_year_dedup(rows)).withColumn("is_latest", F.col("next_year_raw").isNull())
        # each task has one bucket and writes one file for each of the two folders
        (stored.write.mode("overwrite").option("path", path).partitionBy("is_latest").bucketBy(buckets, "fcskey").saveAsTable(table))
        self._stored["years"] = spark.table(table)
        # derived tables must be rebuilt on the stored ones
        for attr in ("latest_labelled", "terrestrial"):
            self.__dict__.pop(attr, None)
        return {"dedup": path, "latest": f"{path}/is_latest=true"}

    def forget(self) -> None:
        """Take the stored table out of the catalog, when its readers are done; its files stay."""
        if self._stored:
            self.ctx.spark.sql(f"DROP TABLE IF EXISTS {self._table}")
            self._stored.clear()
            for attr in ("latest_labelled", "terrestrial"):
                self.__dict__.pop(attr, None)

    @cached_property
    def cover(self) -> DataFrame:
        """FLT-02 + PRJ-10."""
        return add_project_class(cover_screen(self.working), self.p)

    @cached_property
    def timed(self) -> DataFrame:
        """PRJ-15 + FLT-04 (before the stand-year dedup)."""
        return add_inventory_years(self.cover, self.p)

    @property
    def dedup(self) -> DataFrame:
        """DED-02."""
        if "years" in self._stored:
            return self._stored["years"].drop("next_year_raw", "is_latest")
        return self._dedup

    @cached_property
    def _dedup(self) -> DataFrame:
        return stand_year_dedup(self.timed)

    def exploded(self) -> DataFrame:
        """SNP-08 core: records exploded over their validity years."""
        from standlens.operators.snapshots import explode_validity
        if "years" in self._stored:
            return explode_validity(self._stored["years"].drop("is_latest"))
        return explode_validity(self.dedup, bounds_from=self.timed)

    @property
    def latest(self) -> DataFrame:
        """DED-03 + PRJ-10 (snapshot_latest_tbl)."""
        if "years" in self._stored:
            return self._stored["years"].filter("is_latest").drop("next_year_raw", "is_latest")
        # newest year, then newest date, then input order: the stand-year dedup keeps that row, so it need not come first
        return add_project_class(latest_per_stand(self.timed), self.p)

    @cached_property
    def latest_labelled(self) -> DataFrame:
        """PRJ-12 on the department snapshot: null labels -> "Missing / NA"."""
        if self.name == DEPARTMENT:
            return (self.latest.withColumn("l3cover_key", missing_as("l3cover_key", self.p.missing_label))
                        .withColumn("authority_key", missing_as("authority_key", self.p.missing_label)))
        return self.latest

    @cached_property
    def terrestrial(self) -> DataFrame:
        """FLT-05: drop water (null labels drop as well, as in R's filter)."""
        return self.latest_labelled.filter(F.col("l3cover_key") != self.p.water_label)


class Context:
    def __init__(self, spark: SparkSession, inputs: Inputs, p: Params, prepared: DataFrame | None = None):
        self.spark, self.inputs, self.p = spark, inputs, p
        self._prepared = prepared

    @classmethod
    def from_tpch(cls, spark: SparkSession, sf_dir: str, p: Params) -> "Context":
        return cls(spark, tpch_inputs(spark, sf_dir), p)

    # ---- lookups (PRJ-02..06, SET-01) ----
    def _lookup(self, domain: str, df: DataFrame, key: str, extra_rows: int = 0) -> lk.Lookup:
        """Row bound of a lookup: known for literal domains, else None."""
        known = (self.inputs.domain_rows or {}).get(domain)
        return lk.Lookup(df, key, None if known is None else known + extra_rows)

    @cached_property
    def canopy_lookup(self) -> DataFrame:
        return lk.canopy_lookup(self.inputs.domains["canopy_closure"])

    @cached_property
    def l4_lookup(self) -> DataFrame:
        return lk.l4_lookup(self.inputs.domains["cover_type"])

    @cached_property
    def management_lookup(self) -> DataFrame:
        return lk.management_lookup(self.inputs.domains["management"])

    @cached_property
    def authority_lookup(self) -> DataFrame:
        return lk.authority_lookup(self.inputs.domains["authority"])

    @cached_property
    def unit_lookup(self) -> DataFrame:
        return lk.unit_lookup(self.inputs.domains["unit_name"])

    @cached_property
    def l3_lookup(self) -> DataFrame:
        return lk.l3_lookup(lk.ordered_l4(self.inputs.domains["cover_type"]), lk.crosswalk(self.spark))

    # ---- E1: decode stands, label compartments, attach ----
    def _coded(self, s: DataFrame) -> DataFrame:
        s = (s.withColumn("l4covertype_full", F.col("l4covertype"))
              .withColumn("l3covertype", parent_code("l4covertype")))
        s = lk.lookup_join(s, self._lookup("canopy_closure", self.canopy_lookup, "canopy_closure"))
        s = lk.lookup_join(s, self._lookup("cover_type", self.l4_lookup, "l4covertype_full"))
        return lk.lookup_join(s, self._lookup("management", self.management_lookup, "managed_site"))

    def _labelled(self, coded: DataFrame) -> DataFrame:
        s = lk.lookup_join(coded, self._lookup("cover_type", self.l3_lookup, "l3covertype", len(lk.L3_CROSSWALK)))
        front = ["canopy_key", "canopy_closure", "l3cover_key", "l3covertype", "l4cover_key",
                 "l4covertype_full", "management_key"]
        return s.select(*front, *[c for c in s.columns if c not in front])

    @cached_property
    def stands_coded(self) -> DataFrame:
        """PRJ-07 + JN-01: full code, L3 parent code, three domain labels."""
        return self._coded(self.inputs.stands)

    @cached_property
    def stands_labelled(self) -> DataFrame:
        """JN-02 + PRJ-08: L3 label and its source, key fields first."""
        return self._labelled(self.stands_coded)

    @cached_property
    def compartments_labelled(self) -> DataFrame:
        """JN-03 + PRJ-08."""
        c = lk.lookup_join(self.inputs.compartments, self._lookup("authority", self.authority_lookup, "management_type"))
        c = lk.lookup_join(c, self._lookup("unit_name", self.unit_lookup, "unit_name"))
        front = ["authority_key", "management_type", "unit_key", "unit_name"]
        return c.select(*front, *[x for x in c.columns if x not in front])

    @cached_property
    def compartments_unique(self) -> DataFrame:
        """DED-01 (compartments_reusable): one row per fc_key, the first in input order; where a source has none (the test
        binding), the one with the smallest acres. A geometry passes through."""
        c = self.compartments_labelled
        cols = ["fc_key", "authority_key", "management_type", "unit_key", "unit_name", "acres"]
        order = [x for x in ("tb1", "tb2", "tb3") if x in c.columns]
        kept = c.select(*cols, *[x for x in (*order, "geometry") if x in c.columns])
        by = [F.col(x).asc() for x in order] or [F.col("acres").asc_nulls_last(), F.col("management_type").asc(),
                                                 F.col("unit_name").asc()]
        return first_per_key(kept, ["fc_key"], by).drop(*order)

    @cached_property
    def compartment_attributes(self) -> DataFrame:
        """DED-01 (compartment_attributes)."""
        return self.compartments_unique.drop("acres", "geometry")

    def _with_compartments(self, s: DataFrame) -> DataFrame:
        """JN-04 on records with their codes: these, then the attributes of their compartment. Compartments grow with the data, so both
        sides are shuffled whatever their size. A sort-merge join: it spills, and the hot partition of a crowded key is split."""
        attrs = self.compartment_attributes.withColumnRenamed("fc_key", "__fc").hint("merge")
        return s.join(attrs, s["fc_key"].eqNullSafe(attrs["__fc"]), "left").drop("__fc")

    def _decoded(self, s: DataFrame) -> DataFrame:
        """Labels for records that have their compartment's attributes, in the order of ``stands_labelled`` and the attributes behind.
        The lookups of known size need no shuffle, so records that move by a key do so before, with codes in place of labels."""
        attrs = [c for c in self.compartment_attributes.columns if c != "fc_key"]
        s = self._labelled(self._coded(s))
        return s.select(*[c for c in s.columns if c not in attrs], *attrs)

    @cached_property
    def department(self) -> DataFrame:
        """JN-04 + PRJ-09: every record with its compartment's attributes."""
        if self._prepared is not None:
            return self._prepared
        return self._decoded(self._with_compartments(self.inputs.stands))

    @cached_property
    def division(self) -> DataFrame:
        """FLT-01: records whose authority is in the division set."""
        return self.department.filter(F.col("authority_key").isin(*self.p.division))

    def with_created_date(self, df: DataFrame) -> DataFrame:
        return self.inputs.with_created_date(df)

    def _dated(self, df: DataFrame) -> DataFrame:
        """Columns as ``with_created_date`` gives them: the key first, the date last."""
        ends = [c for c in ("fcskey", "created_date") if c in df.columns]
        return df.select(*ends[:1], *[c for c in df.columns if c not in ends], *ends[1:])

    @cached_property
    def department_dated(self) -> DataFrame:
        """The department with created_date. Records move by their stand and then by their compartment, in the columns they are
        delivered with."""
        s = self.inputs.stands
        if self._prepared is not None or self.inputs.created_dates is None or "created_date" in s.columns:
            return self.with_created_date(self.department)
        return self._dated(self._decoded(self._with_compartments(self.with_created_date(s))))

    @cached_property
    def division_dated(self) -> DataFrame:
        """The division with created_date. The compartments come first here: only records of the division move by their stand."""
        s = self.inputs.stands
        if self._prepared is not None or self.inputs.created_dates is None or "created_date" in s.columns:
            return self.with_created_date(self.division)
        kept = self._with_compartments(s).filter(F.col("authority_key").isin(*self.p.division))
        return self._dated(self._decoded(self.with_created_date(kept)))

    @cached_property
    def div(self) -> Scope:
        return Scope(self, self.division, DIVISION)

    @cached_property
    def dept(self) -> Scope:
        return Scope(self, self.department, DEPARTMENT)

    def scope(self, name: str) -> Scope:
        return self.div if name == DIVISION else self.dept
