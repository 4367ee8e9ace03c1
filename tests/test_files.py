"""SRC-01..03: the same answers from files as from the TPC-H binding."""

import os
import tempfile

from pyspark.sql import functions as F

from standlens.plans import analysis as A
from standlens.plans import profile as E
from standlens.plans.context import Context
from standlens.sources.files import file_inputs


def test_file_inputs_reproduce_fixture(spark, ctx):
    out = tempfile.mkdtemp(prefix="standlens-files-")
    # stands as delivered: one file, sorted in the fixture's input order, created_date on the record
    stands = ctx.with_created_date(ctx.inputs.stands).orderBy("tb1", "tb2", "tb3")
    stands.drop("tb1", "tb2", "tb3").coalesce(1).write.parquet(os.path.join(out, "stands"))
    ctx.inputs.compartments.write.parquet(os.path.join(out, "compartments"))
    paths = {}
    for name, df in ctx.inputs.domains.items():
        label = [c for c in df.columns if c != "code"][0]
        p = os.path.join(out, f"domain_{name}")
        df.select("code", F.col(label).alias("label")).coalesce(1).write.option("header", True).csv(p)
        paths[name] = p
    inp = file_inputs(spark, os.path.join(out, "stands"), os.path.join(out, "compartments"), paths)
    fctx = Context(spark, inp, ctx.p)

    def same(a, b):
        key = lambda t: tuple((x is None, str(x)) for x in t)
        return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)

    assert same(E.cover_summary(fctx), E.cover_summary(ctx))
    assert same(E.largest_stands(fctx), E.largest_stands(ctx))          # ties resolved by input order
    assert same(E.date_summary(fctx), E.date_summary(ctx))
    assert same(A.annual_cover_summary(fctx, "department"), A.annual_cover_summary(ctx, "department"))
    assert same(A.report_summary(fctx), A.report_summary(ctx))


def test_cli_on_real_layer_files(spark, ctx):
    from standlens.__main__ import main, params, parse
    out = tempfile.mkdtemp(prefix="standlens-cli-")
    stands = ctx.with_created_date(ctx.inputs.stands).orderBy("tb1", "tb2", "tb3").drop("tb1", "tb2", "tb3")
    stands.coalesce(1).write.parquet(os.path.join(out, "stands"))
    ctx.inputs.compartments.write.parquet(os.path.join(out, "compartments"))
    args = ["--stands", os.path.join(out, "stands"), "--compartments", os.path.join(out, "compartments"),
            "--out", os.path.join(out, "result"), "--current-year", "2001", "--baseline-year", "1997"]
    for name, df in ctx.inputs.domains.items():
        label = [c for c in df.columns if c != "code"][0]
        p = os.path.join(out, f"domain_{name}")
        df.select("code", F.col(label).alias("label")).coalesce(1).write.option("header", True).csv(p)
        args += ["--domain", f"{name}={p}"]
    assert params(parse(args)) == ctx.p
    main(args)
    rep = spark.read.option("header", True).csv(os.path.join(out, "result", "reports", "step3_report_summary"))
    exp = A.report_summary(ctx).collect()
    assert sorted(tuple(r) for r in rep.select(*exp[0].__fields__).collect()) == \
        sorted(tuple(str(x) for x in r) for r in exp)


def _csv(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_readers_match_delivered_names_and_refuse_missing_columns(spark, tmp_path):
    import pytest

    from standlens.sources.readers import read_compartments, read_domains, read_stands
    rows = [(1, 10, 211, 2, 1, 5, 1.5, None, None, "g")]
    raw = spark.createDataFrame(rows, "FCSKEY long, FC_Key long, L4COVERTYPE int, `Canopy Closure` int, ManagedSite int, "
                                      "Sub_Canopy_Cover int, Acres double, Date timestamp, LastEditedDate timestamp, Shape string")
    raw.write.parquet(f"{tmp_path}/stands")
    got = read_stands(spark, f"{tmp_path}/stands", geometry=True).first()
    assert (got.canopy_closure, got.managed_site, got.sub_canopy_cover, got.geometry, got.created_date) == (2, 1, 5, "g", None)
    raw.drop("ManagedSite").write.parquet(f"{tmp_path}/less")
    with pytest.raises(ValueError, match="managed_site"):
        read_stands(spark, f"{tmp_path}/less")
    with pytest.raises(ValueError, match="management_type"):
        read_compartments(spark, f"{tmp_path}/stands")
    turned = _csv(f"{tmp_path}/d.csv", "label,code\nManaged,1\nUnspecified,2\n")
    assert [(r.code, r.management_key) for r in read_domains(spark, {"management": turned})["management"].collect()] == [
        (1, "Managed"), (2, "Unspecified")]
    with pytest.raises(ValueError, match="label"):
        read_domains(spark, {"management": _csv(f"{tmp_path}/e.csv", "code,name\n1,Managed\n")})


def test_first_rows_and_repeated_codes(spark, ctx, tmp_path):
    import pytest

    from standlens.operators import lookup as lk
    from standlens.sources.files import checked_domain, with_input_order
    from standlens.sources.fixture import Inputs
    from standlens.sources.readers import read_compartments, read_domains
    path = f"{tmp_path}/compartments"
    spark.createDataFrame([(7, 1, 1, 50.0, bytearray(b"a")), (7, 2, 1, 3.0, bytearray(b"b"))],
                          "FC_Key long, ManagementType int, UnitName long, Acres double, Geometry binary").coalesce(1).write.parquet(path)
    comp = with_input_order(read_compartments(spark, path, geometry=True))
    own = Context(spark, Inputs(spark, ctx.inputs.stands, comp, ctx.inputs.domains), ctx.p)
    kept = own.compartments_unique.collect()
    assert [(r.management_type, r.acres, bytes(r.geometry)) for r in kept] == [(1, 50.0, b"a")]     # first, not smallest
    assert "geometry" not in own.department.columns
    twice = read_domains(spark, {"cover_type": _csv(f"{tmp_path}/c.csv", "code,label\n419,First\n419,Second\n")})["cover_type"]
    with pytest.raises(ValueError, match="419"):
        checked_domain("cover_type", twice)
    l3 = lk.l3_lookup(lk.ordered_l4(twice), lk.crosswalk(spark))
    assert [r.l3cover_key for r in l3.where("l3covertype = 419").collect()] == ["First"]


def test_files_with_differing_headers_are_read_by_their_own_names(spark, tmp_path):
    import pytest

    from standlens.sources import readers
    path = f"{tmp_path}/layer"
    spark.createDataFrame([(1, 2, 3, 4.0)], "FC_Key long, `Management Type` int, UnitName long, Acres double").write.parquet(path)
    spark.createDataFrame([("5.5", 7, 6, 5, bytearray(b"g"))], "acres string, unit_name int, management_type long, fc_key int, Shape binary") \
        .write.mode("append").parquet(path)
    rows = sorted(tuple(r) for r in readers.read_compartments(spark, path, input_order=True).drop("tb1", "tb2", "tb3").collect())
    assert rows == [(1, 2, 3, 4.0), (5, 6, 7, 5.5)]
    shapes = {r.fc_key: r.geometry for r in readers.read_compartments(spark, path, geometry=True).collect()}
    assert shapes == {1: None, 5: bytearray(b"g")}
    spark.createDataFrame([(1, 2, 3)], "fc_key long, management_type int, unit_name long").write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="acres"):
        readers.read_compartments(spark, path)
    with pytest.raises(ValueError, match="no files"):
        readers.read_compartments(spark, _empty(f"{tmp_path}/none"))


def _empty(path):
    os.makedirs(path)
    return path


def test_one_header_is_read_for_each_job_and_foreign_file(spark, tmp_path, monkeypatch):
    from standlens.sources import readers
    path, seen = f"{tmp_path}/layer", []
    layer = spark.range(40).selectExpr("id AS fc_key", "cast(id AS int) AS `Management Type`", "id AS unit_name", "cast(id AS double) AS acres")
    for _ in range(2):
        layer.repartition(9).write.mode("append").parquet(path)
    layer.coalesce(1).write.parquet(f"{tmp_path}/other")
    part = next(x for x in os.listdir(f"{tmp_path}/other") if x.startswith("part"))
    with open(f"{tmp_path}/other/{part}", "rb") as src, open(f"{path}/sent [by] mail.parquet", "wb") as to:
        to.write(src.read())
    real = readers.header
    monkeypatch.setattr(readers, "header", lambda *a: seen.append(a[1]) or real(*a))
    assert readers.read_compartments(spark, path).groupBy("fc_key").count().where("count = 3").count() == 40
    assert len(seen) == 3 and len(readers.deliveries(spark, path)) == 1
    alone = readers.read_compartments(spark, f"{path}/sent [by] mail.parquet".replace("[", "\\[").replace("]", "\\]"))
    assert alone.count() == 40


def test_a_text_layer_is_read_header_by_header(spark, tmp_path):
    from standlens.sources.readers import read_compartments
    path = _empty(f"{tmp_path}/csv")
    _csv(f"{path}/a.csv", "FC Key,Management Type,Unit Name,Acres\n1,2,3,4.5\n2,2,3,\n")
    _csv(f"{path}/b.csv", "acres,unit_name,fc_key,management_type\n9.5,8,7,6\n")
    rows = [tuple(r)[:4] for r in read_compartments(spark, path, fmt="csv", input_order=True).orderBy("tb1", "tb2", "tb3").collect()]
    assert rows == [(1, 2, 3, 4.5), (2, 2, 3, None), (7, 6, 8, 9.5)]


def test_a_domain_of_several_files_keeps_its_order(spark, tmp_path):
    from standlens.operators import lookup as lk
    from standlens.sources.readers import read_domains
    path = _empty(f"{tmp_path}/cover")
    _csv(f"{path}/part-0.csv", "code,label\n419,First\n420,Second\n419,Third\n")
    # the larger file is read first by Spark
    _csv(f"{path}/part-1.csv", "label,code\n" + "".join(f"Late {i},{i}\n" for i in range(500, 419, -1)) + "Last,419\n")
    domain = read_domains(spark, {"cover_type": path})["cover_type"]
    rows = [(r.code, r.l4cover_key) for r in domain.orderBy("input_order").collect()]
    assert rows[:3] == [(419, "First"), (420, "Second"), (419, "Third")] and rows[3] == (500, "Late 500") and rows[-1] == (419, "Last")
    l3 = {r.l3covertype: r.l3cover_key for r in lk.l3_lookup(lk.ordered_l4(domain), lk.crosswalk(spark)).collect()}
    assert l3[419] == "First" and l3[420] == "Second"
