"""Column functions on hand-made rows (classifier branches, R semantics)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from standlens.config import Params
from standlens.functions import classes as C
from standlens.functions import formatting as Fm
from standlens.functions.codes import code_digits, has_prefix, parent_code
from standlens.functions.labels import canopy_class, clean_cover_label, factor, level_order, missing_as

P = Params(current_year=2001, baseline_year=1997)


def col1(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype, True)]))
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_cover_label(spark):
    got = col1(spark, ["310 - A - B (OI)", "A (OI) x", "", None, "2121 - Forage - Mixed", "500 -Water"],
               T.StringType(), clean_cover_label)
    assert got == ["A - B", "A (OI) x", "", None, "Forage - Mixed", "Water"]


def test_parent_code_and_digits(spark):
    assert col1(spark, [None, 0, 2, 31021, 4191], T.IntegerType(), parent_code) == [None, 0, 2, 310, 419]
    assert col1(spark, ["abc", "12x45"], T.StringType(), parent_code) == [None, None]
    assert col1(spark, [None, 0, 31021], T.IntegerType(), code_digits) == [None, 1, 5]
    assert col1(spark, [None, 211, 311, 2], T.IntegerType(), lambda c: has_prefix(c, "2")) == [None, True, False, True]


def test_canopy_class(spark):
    got = col1(spark, ["0-25", "25-50", "50-75", "75-100", None, "NA", "Missing", "Missing / NA", "Unspecified", "odd"],
               T.StringType(), canopy_class)
    assert got == ["0–<25", "25–<50", "50–<75", "75–100", "NA", "NA", "NA", "NA", "NA", None]


def test_factor_and_order(spark):
    assert col1(spark, ["b", "z", None], T.StringType(), lambda c: factor(c, ["a", "b"])) == ["b", None, None]
    assert col1(spark, ["b", "z", None], T.StringType(), lambda c: level_order(c, ["a", "b"])) == [2, None, None]
    assert col1(spark, [None, "x"], T.StringType(), missing_as) == ["Missing / NA", "x"]


def test_size_classes_exact_breaks(spark):
    got = col1(spark, [0.0, 4.99, 5.0, 19.5, 20.0, 50.0, 99.9, 100.0, None], T.DoubleType(),
               lambda c: C.size_class(c, P, C.SIZE_LABELS_ANALYSIS))
    assert got == ["<5", "<5", "5–19", "5–19", "20–49", "50–99", "50–99", "≥100", "≥100"]


def test_age_classes(spark):
    got = col1(spark, [0, 4, 5, 10, 14, 15, 40], T.IntegerType(), lambda c: C.age_class(c, P))
    assert got == ["0–<5 years", "0–<5 years", "5–<10 years", "10–<15 years", "10–<15 years", "15+ years",
                   "15+ years"]


def test_years(spark):
    assert col1(spark, [None, 1990, 1997, 1998], T.IntegerType(), lambda c: C.clamp_year(c, P)) == [None, 1997, 1997,
                                                                                                    1998]
    assert col1(spark, [1997, 2000], T.IntegerType(), lambda c: C.year_label(c, P)) == ["≤1997", "2000"]
    assert col1(spark, [None, 1949, 1950, 2001, 2002], T.IntegerType(), lambda c: C.valid_year(c, P)) == [
        False, False, True, True, False]


def test_project_cover_class(spark):
    schema = "code int, l3 string"
    df = spark.createDataFrame([(211, "Cropland"), (310, "Herbaceous Openland"), (None, "Herbaceous Openland"),
                                (None, None), (422, "Natural Pines"), (2, None)], schema)
    got = [r[0] for r in df.select(C.project_cover_class("code", "l3", P)).collect()]
    assert got == ["Agriculture", "Herbaceous Openland", "Herbaceous Openland", None, None, "Agriculture"]


def test_formatting_half_even(spark):
    got = col1(spark, [0.1234, 0.00025, None], T.DoubleType(), Fm.percent_label)
    assert got == ["12.3%", "0.0%", None]
    assert col1(spark, [1234.5, 1235.5, 0.0], T.DoubleType(), Fm.comma) == ["1,234", "1,236", "0"]
    assert col1(spark, [1234.56, 12.25], T.DoubleType(), Fm.number) == ["1 234.6", "12.2"]
    assert col1(spark, [1234.4], T.DoubleType(), Fm.format_acres) == ["1,234 ac"]


def test_clean_names_and_drop_geometry(spark):
    from standlens.sources.readers import clean_names, snake_case
    assert [snake_case(x) for x in ["FCSKEY", "FC_Key", "L4COVERTYPE", "Canopy Closure", "ManagedSite",
                                    "LastEditedDate", "Shape_Length", "2nd col", "a--b"]] == \
        ["fcskey", "fc_key", "l4covertype", "canopy_closure", "managed_site", "last_edited_date", "shape_length",
         "x2nd_col", "a_b"]
    df = spark.createDataFrame([(1, 2, bytearray(b"\x01"))], "A int, a int, Geometry binary")
    out = clean_names(df)
    assert out.columns == ["a", "a_2", "geometry"]
    # PRJ-09: dropping geometry is a no-op when the column is absent
    assert out.drop("geometry").columns == ["a", "a_2"]
    assert out.drop("geometry").drop("geometry").columns == ["a", "a_2"]


def test_int_prefix_ranges_equal_text_prefix(spark):
    from standlens.functions.codes import int_code_has_prefix
    vals = [None, 0, 1, 2, 3, 19, 20, 29, 30, 199, 200, 211, 299, 300, 2121, 2999, 3000, 31021, 29999, 30000,
            -2, -211, 2147483647, 2000000000]
    df = spark.createDataFrame([(v,) for v in vals], "c int")
    for pre in ("2", "21", "0", "3"):
        got = df.select(int_code_has_prefix("c", pre).alias("a"), has_prefix("c", pre).alias("b")).collect()
        assert all(r.a == r.b for r in got), pre


def test_params_overrides(tmp_path):
    import json

    import pytest

    from standlens.__main__ import params, parse
    f = tmp_path / "p.json"
    f.write_text(json.dumps({"area_top_k": 20, "size_breaks": [1, 10, 40, 80], "division": ["Wildlife", "State Parks"]}))
    p = params(parse(["--sf-dir", "x", "--out", "y", "--params", str(f)]))
    assert p.area_top_k == 20 and p.size_breaks == (1, 10, 40, 80) and p.division == ("Wildlife", "State Parks")
    with pytest.raises(ValueError):
        P.with_overrides({"no_such": 1})


def test_custom_breaks_get_generated_labels(spark):
    from dataclasses import replace
    p = replace(P, size_breaks=(10.0, 100.0), age_breaks=(3, 6, 9, 12))
    got = col1(spark, [1.0, 10.0, 150.0, None], T.DoubleType(), lambda c: C.size_class(c, p))
    assert got == ["<10 acres", "10–100 acres", "100+ acres", "100+ acres"]
    got = col1(spark, [2, 3, 12], T.IntegerType(), lambda c: C.age_class(c, p))
    assert got == ["<3 years", "3–6 years", "12+ years"]
