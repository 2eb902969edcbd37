from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import valuetypes as vt
from ledgerloom.operators import profile


def accepts(make, *errors):
    def test(v):
        try:
            make(v)
            return True
        except (ValueError, *errors):
            return False

    return test


is_int, is_float = accepts(int), accepts(float)
FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d")


def is_moment(v):
    return any(accepts(lambda x, f=f: datetime.strptime(x, f))(v) for f in FORMATS)


def expected(v):
    if v is None or v == "":
        return None
    bits = 0
    if is_int(v):
        bits |= vt.INTEGER | (vt.FITS_BIGINT if -(2**63) <= int(v) < 2**63 else 0)
    if is_float(v):
        bits |= vt.FLOAT
    if is_moment(v):
        bits |= vt.TIMESTAMP
    if v.lower() in ("true", "false"):
        bits |= vt.BOOLEAN
    return bits


EDGES = [
    None, "", " ", "0", "1", "-5", "+7", " 12 ", "1_000", "1__0", "_1", "1_", "007", "9223372036854775807",
    "9223372036854775808", "-9223372036854775808", "-9223372036854775809", "1.5", ".5", "5.", ".", "1e5", "1E-5",
    "1e", "1_0.2_5", "1._5", "nan", "NaN", "-inf", "Infinity", "infinit", "0x10", "1,5", "\t3\n", "\x1f4", "\xa05",
    "2024-01-05", "2024-1-5", "2024-01-05 10:20:30", "2024-01-05T10:20:30", "2024-01-05t1:2:3",
    "2024-01-05 10:20:30.5", "2024-02-30", "2023-02-29", "2024-02-29", "0000-01-01", "0001-01-01", "24-01-05",
    "2024-13-01", "2024-01-05  10:20:30", "2024-01-05 24:00:00", "2024-01-05 10:20:60", "2024-01- 5", "2024-01-05 ",
    "20240105", "true", "FALSE", " true", "yes", "asdf", "35240112345678000199550010000012341000012345", "--1", "1-2",
]


def classes(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.selectExpr(vt.value_classes("v")).collect()]


def test_edge_values(spark):
    got = classes(spark, EDGES)
    assert {v: g for v, g in zip(EDGES, got) if g != expected(v)} == {}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(
    st.text("0123456789+-_. eEinfaT:", max_size=12),
    st.integers().map(str), st.floats().map(str),
    st.datetimes().map(lambda d: d.strftime("%Y-%m-%d %H:%M:%S")),
), min_size=50, max_size=200))
def test_random_values(spark, values):
    got = classes(spark, values)
    assert {v: g for v, g in zip(values, got) if g != expected(v)} == {}


TYPED = """
    SELECT * FROM VALUES
      (1, 2L, 1.0D, float(3), 2.50BD, true, date'2024-01-05', timestamp_ntz'2024-01-05 10:00:00', timestamp'2024-01-05 10:00:00.5'),
      (-1, 9223372036854775807L, double('NaN'), float(1e20), 3.00BD, false, date'0001-01-01', timestamp_ntz'2024-01-05', timestamp'2024-01-05'),
      (NULL, NULL, double('-Infinity'), NULL, NULL, NULL, NULL, NULL, NULL)
    AS t(i, l, d, f, m, b, day, at, frac)
"""


def test_typed_columns_are_judged_like_their_text(spark):
    typed = spark.sql(TYPED)
    late = spark.sql("SELECT date_add(date'9999-12-31', 1) AS day, timestamp_ntz'0001-01-01' - interval 1 day AS at")
    for df in (typed, late, typed.limit(0)):
        text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        by_type, by_text = (
            sorted(map(tuple, profile.infer_column_types({"t": x}).collect())) for x in (df, text)
        )
        assert by_type == by_text
    assert [vt.classes_of_type(f.dataType, f.name) is None for f in typed.schema].count(True) == 1


def test_type_order_and_overflow(spark):
    rows = [
        ("1", "1", "2024-01-05", "true", "", "1", "9999999999999999999"),
        ("0", "2.5", "2024-1-6 1:2:3", "False", None, "x", "1"),
    ]
    df = spark.createDataFrame(rows, "flag string, num string, at string, ok string, none string, mix string, big string")
    got = {r.column_name: (r.inferred_type, r.overflow) for r in profile.infer_column_types({"t": df}).collect()}
    assert got == {
        "flag": ("BIGINT", False),
        "num": ("DOUBLE PRECISION", False),
        "at": ("TIMESTAMP", False),
        "ok": ("BOOLEAN", False),
        "none": ("TEXT", False),
        "mix": ("TEXT", False),
        "big": ("BIGINT", True),
    }


def test_ddl_and_conflicts(spark):
    a = spark.createDataFrame([("1", "x")], "` Tax ID ` string, `na``me` string")
    b = spark.createDataFrame([("n-1",)], "` Tax ID ` string")
    types = profile.infer_column_types({"b": b, "a": a})
    assert [r.ddl for r in profile.generate_ddl(types).collect()] == [
        'CREATE TABLE IF NOT EXISTS "a" (\n    "tax_id" BIGINT,\n    "na`me" TEXT\n);',
        'CREATE TABLE IF NOT EXISTS "b" (\n    "tax_id" TEXT\n);',
    ]
    (conflict,) = profile.type_conflicts(types).collect()
    assert (conflict.n_types, conflict.found) == (2, "a:BIGINT, b:TEXT")


def test_nulls_are_only_nulls(spark):
    df = spark.createDataFrame([(None, ""), (float("nan"), "x")], "a double, b string")
    got = {r.column_name: (r.n_nulls, r.null_ratio) for r in profile.null_profile({"t": df}).collect()}
    assert got == {"a": (1, 0.5), "b": (0, 0.0)}


def test_empty_tables(spark):
    df = spark.range(0)
    assert [r.null_ratio for r in profile.null_profile({"t": df}).collect()] == [None]
    assert [r.inferred_type for r in profile.infer_column_types({"t": df}).collect()] == ["TEXT"]
    assert {tuple(r) for r in profile.load_validation({"t": df, "u": spark.range(4)}).collect()} == {
        ("t", 0), ("u", 4), ("TOTAL", 4),
    }


def test_volumetrics_order(spark):
    tables = {"b": spark.range(2), "a": spark.range(2), "c": spark.range(9).selectExpr("id", "id AS x")}
    assert [tuple(r) for r in profile.table_volumetrics(tables).collect()] == [("c", 9, 2), ("a", 2, 1), ("b", 2, 1)]


@pytest.mark.parametrize(
    "head, middle, tail, kind",
    [
        ("7", "7", "", "BIGINT"),
        ("1", "_1", "", "BIGINT"),
        ("", " ", "5", "BIGINT"),
        ("5", " ", "", "BIGINT"),
        ("1", "1", ".", "DOUBLE PRECISION"),
        ("1.", "0_1", "e5", "DOUBLE PRECISION"),
        ("1", "_1", "_", "TEXT"),
        ("9", "9", "x", "TEXT"),
        ("1_", "1_", "_1", "TEXT"),
    ],
)
def test_a_very_long_value_is_judged_like_a_short_one(spark, head, middle, tail, kind):
    values = (head + middle * 500_000 + tail, head + middle * 3 + tail)
    judged = profile.infer_column_types({"t": spark.createDataFrame([values], "long string, short string")}).collect()
    assert {r.column_name: r.inferred_type for r in judged} == {"long": kind, "short": kind}
