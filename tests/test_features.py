"""Levels, vocabulary and collapse."""

import datetime as dt
import math
import random
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from dossier import EntitySpec
from dossier.functions import digest
from dossier.functions.digest import json_digest, table_digest
from dossier.functions.levels import folded_label, level_code, level_order
from dossier.functions.naming import base_column, feature_names
from dossier.functions.numeric import half_round
from dossier.operators.collapse import category_features, collapse, numeric_features
from dossier.operators.vocabulary import fit_vocabulary, unseen_levels

SPEC = EntitySpec(id_col="id", date_col="day", seq_col="seq", cat_cols=("cat",))
SCHEMA = "id string, day date, seq long, x double, cat string"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows_by_id(df, key="id"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def tiny(spark):
    nan = float("nan")
    return spark.createDataFrame([
        ("a", day(0), 1, 1.0, "u"), ("a", day(1), 2, None, "v"),
        ("a", day(2), 3, 3.0, ""), ("a", day(3), 4, None, "v"),
        ("b", day(0), 5, nan, "u"), ("b", day(1), 6, 2.0, None),
        ("c", day(0), 7, -1.5, "NaN"),
        ("d", day(0), 8, None, "u"), ("d", day(1), 9, nan, "u"),
    ], SCHEMA)


def test_numbers_skip_null_and_nan(tiny):
    got = rows_by_id(numeric_features(tiny, SPEC))
    assert got["a"] == {"id": "a", "x_mean": 2.0, "x_max": 3.0, "x_last": 3.0, "x_diff": 1.0}
    assert got["b"] == {"id": "b", "x_mean": 2.0, "x_max": 2.0, "x_last": 2.0, "x_diff": 0.0}
    assert got["c"]["x_last"] == -1.5
    assert set(list(got["d"].values())[1:]) == {None}


def test_categories_keep_missing_as_a_level(tiny):
    vocabulary = fit_vocabulary(tiny, SPEC)
    assert vocabulary == {"cat": ["u", "v", "NaN"]}
    got = rows_by_id(category_features(tiny, SPEC, vocabulary))
    assert (got["a"]["cat_u"], got["a"]["cat_v"], got["a"]["cat_NaN"]) == (0.25, 0.5, 0.25)
    assert got["a"]["cat_last"] == 1
    assert got["b"]["cat_last"] == 2
    assert got["c"]["cat_NaN"] == 1.0


def test_types_and_names(tiny):
    vocabulary = fit_vocabulary(tiny, SPEC)
    out = collapse(tiny, SPEC, vocabulary)
    assert out.columns == ["id", *feature_names(["x"], vocabulary)]
    types = {f.name: f.dataType for f in out.schema.fields}
    assert isinstance(types["x_mean"], T.FloatType) and isinstance(types["cat_last"], T.ByteType)


@pytest.mark.parametrize("unit", ["day", "micro"])
def test_tied_dates_go_by_sequence(spark, unit):
    df = spark.createDataFrame([("a", day(0), 2, 20.0, "u"), ("a", day(0), 1, 10.0, "v"),
                                ("a", None, 0, 5.0, "w")], SCHEMA)
    spec = replace(SPEC, date_unit=unit)
    with_null = rows_by_id(collapse(df, spec, fit_vocabulary(df, spec)))
    assert with_null["a"]["x_last"] == 5.0          # no date sorts last
    dated = rows_by_id(collapse(df.where("day is not null"), spec, fit_vocabulary(df, spec)))
    assert (dated["a"]["x_last"], dated["a"]["cat_last"]) == (20.0, 0)


def test_row_order_does_not_matter_even_without_sequence(spark):
    rng = random.Random(1)
    rows = [("e%d" % rng.randrange(5), day(rng.randrange(3)), i, float(rng.randrange(9)),
             rng.choice("uvw")) for i in range(200)]
    spec = replace(SPEC, seq_col=None, cat_cols=("cat",))
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).drop("seq").repartition(seed + 1)
        out = collapse(df, spec, {"cat": ["u", "v", "w", "NaN"]})
        seen.add(str(sorted(out.collect())))
    assert len(seen) == 1


def test_one_row_per_entity(tiny):
    out = numeric_features(tiny, SPEC)
    assert out.count() == out.select("id").distinct().count() == 4


@pytest.mark.parametrize("seq", [-1, 1 << 40])
def test_unpackable_sequence_fails_loudly(spark, seq):
    df = spark.createDataFrame([("a", day(0), seq, 1.0, "u")], SCHEMA)
    with pytest.raises(PySparkException, match="date_unit"):
        numeric_features(df, SPEC).collect()
    assert numeric_features(df, replace(SPEC, date_unit="micro")).first().x_last == 1.0


def test_time_of_day_needs_micro(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 5), 1, 1.0)],
                               "id string, day timestamp, seq long, x double")
    spec = replace(SPEC, cat_cols=())
    with pytest.raises(PySparkException, match="date_unit"):
        numeric_features(df, spec).collect()
    text = df.withColumn("day", F.col("day").cast("string"))
    with pytest.raises(PySparkException, match="date_unit"):
        numeric_features(text, spec).collect()
    dated = text.withColumn("day", F.substring("day", 1, 10))
    assert numeric_features(dated, spec).first().x_last == 1.0


def test_batches_of_columns_give_the_same_table(tiny):
    wide = tiny.withColumns({f"x{i}": F.col("x") * i for i in range(5)})
    vocabulary = fit_vocabulary(wide, SPEC)
    one = collapse(wide, SPEC, vocabulary)
    many = collapse(wide, SPEC, vocabulary, batch=4)
    assert many.columns == one.columns
    assert sorted(many.collect()) == sorted(one.collect())
    with pytest.raises(PySparkException, match="without an id"):
        collapse(wide.withColumn("id", F.lit(None).cast("string")), SPEC, vocabulary, batch=4).collect()


def test_missing_columns_are_named(tiny):
    with pytest.raises(KeyError, match="cat"):
        collapse(tiny.drop("cat"), SPEC, {"cat": ["NaN"]})
    with pytest.raises(KeyError, match="id"):
        collapse(tiny.drop("id"), SPEC, {"cat": ["NaN"]})


def test_level_named_last_is_refused(tiny):
    with pytest.raises(ValueError, match="cat_last"):
        collapse(tiny, SPEC, {"cat": ["last", "NaN"]})


def test_collapse_hashes_and_combines_before_the_shuffle(tiny):
    plan = collapse(tiny, SPEC, fit_vocabulary(tiny, SPEC))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "partial_max_by" in plan
    micro = numeric_features(tiny, replace(SPEC, date_unit="micro"))
    assert "SortAggregate" not in micro._jdf.queryExecution().toString()


def test_levels_of_floats_and_text(spark):
    values = [0.0, -0.0, -1.0, 1.5, None, float("nan"), 1e20]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(folded_label(F.col("v"), T.DoubleType(), "NaN")).collect()]
    assert got == ["0", "0", "-1", "1.5", "NaN", "NaN", "100000000000000000000"]
    codes = [r[0] for r in df.select(
        level_code(F.col("v"), T.DoubleType(), ["-1", "0", "NaN"], "NaN")).collect()]
    assert codes == [1, 1, 0, 2, 2, 2, 2]
    texts = spark.createDataFrame([("CR",), ("",), (None,), ("NaN",), ("ZZ",)], "v string")
    codes = [r[0] for r in texts.select(
        level_code(F.col("v"), T.StringType(), ["CR", "NaN"], "NaN")).collect()]
    assert codes == [0, 1, 1, 1, 1]


def test_a_number_column_never_matches_text_it_cannot_print(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    code = level_code(F.col("v"), T.DoubleType(), ["01", "1", "NaN"], "NaN")
    assert df.select(code).first()[0] == 1


@pytest.mark.parametrize("kind", ["float", "double", "bigint", "string"])
def test_every_level_of_a_vocabulary_gets_its_code(spark, kind):
    values = {"float": ["0.1", "2", "1.0E-5", "1.6E9"], "double": ["0.1", "-3", "1.25E-7"],
              "bigint": ["7", "-1", "9007199254740993"], "string": ["01", "1", "x", "1.0"]}[kind]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v string")
    df = df.withColumn("cat", F.col("v").cast(kind)).drop("v")
    spec = EntitySpec(id_col="id", date_col=None, cat_cols=("cat",))
    vocabulary = fit_vocabulary(df, spec)
    assert len(vocabulary["cat"]) == len(values) + 1
    out = category_features(df, spec, vocabulary)
    assert sorted(r.cat_last for r in out.collect()) == list(range(len(values)))


def test_natural_level_order(spark):
    levels = ["10", "2", "-1", "O", "1d", "01", "1"]
    df = spark.createDataFrame([(v,) for v in levels], "level string")
    got = [r[0] for r in df.orderBy(*level_order(F.col("level"))).collect()]
    assert got == ["-1", "01", "1", "2", "10", "1d", "O"]


def test_unseen_levels_are_counted_and_fall_to_missing(spark):
    df = spark.createDataFrame([("a", day(0), i, 1.0, level) for i, level in
                                enumerate(["u", "z9", "z1", "z1", "", "10", "9"])], SCHEMA)
    vocabulary = {"cat": ["u", "NaN"]}
    row = unseen_levels(df, SPEC, vocabulary, show=3).first()
    assert (row.n_rows, row.levels) == (5, ["9", "10", "z1"])
    out = category_features(df, SPEC, vocabulary).first()
    assert math.isclose(out.cat_NaN, 6 / 7) and out.cat_last == 1


def test_too_many_levels_is_an_error(tiny):
    with pytest.raises(ValueError, match="category"):
        fit_vocabulary(tiny, SPEC, max_levels=1)


def test_half_rounding_is_that_of_numpy(spark):
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(0)
    values = [0.0, -0.5, 1e-7, 2048.5, 2049.5, 65504.0, 65519.9, 65520.0, 70000.0, -70000.0,
              5.96e-8, 2.9e-8, 6.1e-5, float("inf")]
    values += list(rng.normal(0, 1, 500)) + list(10.0 ** rng.uniform(-9, 5, 500))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(half_round(F.col("v"))).collect()]
    with np.errstate(over="ignore"):
        want = np.array(values).astype("float32").astype("float16").astype("float64")
    assert got == list(want)


def test_base_columns(spark):
    names = ["B_30_1", "B_30_last", "P_2_mean", "D_39_diff", "odd", "B_300_max"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r[0] for r in df.select(base_column(F.col("f"), ["B_30"])).collect()]
    assert got == ["B_30", "B_30", "P_2", "D_39", "odd", "B_300"]


def test_digests(spark):
    assert json_digest({"a": 1, "b": [2]}) == json_digest({"b": [2], "a": 1})
    assert json_digest({"a": 1}) != json_digest({"a": 2})
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(2, None), (1, "x")], "i int, s string")
    c = spark.createDataFrame([(2, ""), (1, "x")], "i int, s string")
    assert table_digest(a).first() == table_digest(b).first() != table_digest(c).first()


def test_content_digests_add_up(spark, tmp_path):
    rows = [(i % 7, f"v{i % 5}" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string")
    whole = digest.content_digest(df).first()
    assert whole == digest.content_digest(df.repartition(9)).first()
    assert whole != digest.content_digest(df.distinct()).first() and whole.n_rows == 200
    for name in ("one", "copy"):
        df.limit(120).write.parquet(f"{tmp_path}/{name}")
    df.subtract(df.limit(0)).write.parquet(f"{tmp_path}/other")
    one, copy = (digest.file_digests(spark.read.parquet(f"{tmp_path}/{n}")) for n in ("one", "copy"))
    plain = lambda d: sorted((r.n_rows, tuple(r.lanes)) for r in d.collect())
    assert plain(one) == plain(copy)
    both = digest.add_digests(one.unionByName(copy)).first()
    assert both == digest.content_digest(df.limit(120).unionByName(df.limit(120))).first()
    back = digest.add_digests(one.withColumn("s", F.lit(1)).unionByName(copy.withColumn("s", F.lit(-1))), F.col("s"))
    assert back.first() == digest.content_digest(df.limit(0)).first()


def test_digest_of_a_known_vocabulary():
    # The vocabulary of the public statement data and its digest.
    known = {
        "B_30": ["0", "1", "2", "NaN"],
        "B_38": ["1", "2", "3", "4", "5", "6", "7", "NaN"],
        "D_114": ["0", "1", "NaN"],
        "D_116": ["0", "1", "NaN"],
        "D_117": ["-1", "1", "2", "3", "4", "5", "6", "NaN"],
        "D_120": ["0", "1", "NaN"],
        "D_126": ["-1", "0", "1", "NaN"],
        "D_63": ["CL", "CO", "CR", "XL", "XM", "XZ", "NaN"],
        "D_64": ["-1", "O", "R", "U", "NaN"],
        "D_66": ["0", "1", "NaN"],
        "D_68": ["0", "1", "2", "3", "4", "5", "6", "NaN"],
    }
    assert json_digest(known) == "9f16d9d9ee03"
    assert len(feature_names([f"n{i}" for i in range(177)], known)) == 775


def test_digests_of_rows_that_look_alike_differ(spark):
    rows = [("a|b", "c", None), ("a", "b|c", "\\N"), ("a", "b|c", None), ("a|b|c", "", None), ("a", None, "-")]
    digests = {table_digest(spark.createDataFrame([r], "x string, y string, z string")).first().digest for r in rows}
    assert len(digests) == len(rows)
