import hashlib

import pytest
from pyspark.sql import functions as F

from tabprep.functions import text
from tabprep.functions.columns import column_roles
from tabprep.operators import clean, impute
from tabprep.plans.employees import clean_employees
from tabprep.plans.listings import IMPUTED_COLUMNS, LISTING_COLUMNS, clean_listings


def values(df, column):
    return [r[column] for r in df.collect()]


def test_currency_text(spark):
    df = spark.createDataFrame(
        [("$1,234.50",), ("$0.00",), ("N/A",), ("",), (None,), ("$-3.00",), ("12",)], "price string"
    )
    assert values(clean.clean_currency(df, "price"), "price") == [1234.5, 0.0, None, None, None, -3.0, 12.0]


def test_open_range_drops_bounds_null_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (0.01,), (249.99,), (250.0,), (None,), (float("nan"),)], "price double")
    assert values(clean.filter_open_range(df, "price"), "price") == [0.01, 249.99]


def test_upper_bound_drops_null(spark):
    df = spark.createDataFrame([(365,), (366,), (None,)], "minimum_nights int")
    assert values(clean.filter_upper_bound(df, "minimum_nights"), "minimum_nights") == [365]


def test_every_numeric_type_becomes_double(spark):
    df = spark.sql("SELECT 1 AS a, 2L AS b, CAST(3 AS DECIMAL(5, 1)) AS c, 'x' AS d, CAST(null AS INT) AS e")
    out = clean.cast_numbers_to_double(df)
    assert [t for _, t in out.dtypes] == ["double", "double", "double", "string", "double"]
    assert tuple(out.first()) == (1.0, 2.0, 3.0, "x", None)


def test_spared_keys_keep_their_digits(spark):
    df = spark.sql("SELECT 9007199254740993L AS id, 2L AS n")
    assert tuple(clean.cast_numbers_to_double(df, spare=["id"]).first()) == (9007199254740993, 2.0)


def test_label_of_nan_is_missing(spark):
    df = spark.createDataFrame([(200.0,), (100.0,), (None,), (float("nan"),)], "price double")
    assert [r["c"] for r in clean.binary_label(df, "price", "c").collect()] == [1.0, 0.0, None, None]


def test_flags_mark_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (None, None), (float("nan"), 3)], "a double, b int")
    out = clean.add_missing_flags(df, ["a", "b"]).select("a_na", "b_na").collect()
    assert [tuple(r) for r in out] == [(0.0, 0.0), (1.0, 1.0), (1.0, 0.0)]


def test_binary_label_at_the_threshold(spark):
    df = spark.createDataFrame([(149.99,), (150.0,), (None,)], "price double")
    out = clean.binary_label(df, "price", "class")
    assert out.columns == ["class"] and values(out, "class") == [0.0, 1.0, None]


def test_ssn_repair(spark):
    df = spark.createDataFrame([("324469083",), ("628-40-9043",), (None,)], "ssn string")
    assert values(clean.repair_ssn(df), "ssn") == ["324-46-9083", "628-40-9043"]
    assert values(clean.repair_ssn(df, keep_null=True), "ssn") == ["324-46-9083", "628-40-9043", None]
    with_hyphen, without = clean.split_by_substring(df, "ssn", "-")
    assert values(with_hyphen, "ssn") == ["628-40-9043"] and values(without, "ssn") == ["324469083"]


def test_title_case_splits_on_spaces_only(spark):
    df = spark.createDataFrame([("CAROL",), ("rachel ann",), ("MC-DONALD",)], "name string")
    assert values(clean.title_case_columns(df, ["name"]), "name") == ["Carol", "Rachel Ann", "Mc-donald"]


def test_amounts_hash_the_same_whatever_their_type(spark):
    df = spark.sql("SELECT 1000 AS a, 1000.0D AS b, 1.0E7D AS c")
    row = clean.anonymize_columns(df, amounts=["a", "b", "c"]).first()
    assert row["a"] == row["b"] == hashlib.sha256(b"1000.00").hexdigest()
    assert row["c"] == hashlib.sha256(b"10000000.00").hexdigest()


def test_salt_changes_the_hash(spark):
    df = spark.createDataFrame([("628-40-9043",)], "ssn string")
    plain = df.select(text.anonymize(F.col("ssn")).alias("h")).first()["h"]
    salted = df.select(text.anonymize(F.col("ssn"), "s").alias("h")).first()["h"]
    assert plain == hashlib.sha256(b"628-40-9043").hexdigest() and len(salted) == 64 and plain != salted


def test_employees_match_after_repair(spark):
    df = spark.createDataFrame(
        [
            ("Rachel", "628-40-9043", 1000.0),
            ("RACHEL", "628409043", 1000.0),
            ("CAROL", "324469083", 2000.0),
            ("Nobody", None, 1.0),
        ],
        "first_name string, ssn string, salary double",
    )
    out = clean_employees(df)
    assert sorted(values(out, "first_name")) == ["Carol", "Rachel"]
    assert all(len(r["ssn"]) == 64 and len(r["salary"]) == 64 for r in out.collect())
    assert out.count() == clean.dedup_rows(out).count()


def test_union_matches_names_and_keeps_copies(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1)], "b string, a int")
    assert [tuple(r) for r in clean.union_rows(a, b).collect()] == [(1, "x"), (1, "x")]


def test_drop_nulls_and_fill(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("c", float("nan"))], "k string, v double")
    assert values(clean.drop_nulls(df), "k") == ["a"]
    assert values(impute.impute_category(df, ["k"]), "k") == ["a", "absent", "c"]
    assert values(impute.impute_zero(df, ["v"]), "v") == [1.0, 2.0, 0.0]


def test_roles_take_every_numeric_type(spark):
    df = spark.sql("SELECT 'x' AS s, 1 AS i, 2L AS l, 3.0D AS d, true AS b, 9.0D AS price")
    found = column_roles(df, labels=["price"])
    assert found.categorical == ["s"] and found.numeric == ["i", "l", "d"]


def test_imputer_example(spark):
    nan = float("nan")
    # Rows of the worked imputation example.
    df = spark.createDataFrame([(1.0, nan), (2.0, nan), (nan, 3.0), (4.0, 4.0), (5.0, 5.0)], "a double, b double")
    for out in (
        impute.impute_mean(df, ["a", "b"], {"a": "out_a", "b": "out_b"}),
        impute.imputer_stage(["a", "b"], outputs=["out_a", "out_b"]).fit(df).transform(df),
    ):
        assert values(out, "out_a") == [1.0, 2.0, 3.0, 4.0, 5.0]
        assert values(out, "out_b") == [4.0, 4.0, 3.0, 4.0, 5.0]


def test_median_is_an_element_and_mode_takes_the_smallest(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 5.0), (3.0, 5.0), (10.0, 7.0), (None, None)], "a double, b double")
    assert values(impute.impute_median(df, ["a"]), "a")[-1] == 2.0
    assert values(impute.impute_mode(df, ["b"]), "b")[-1] == 5.0
    for strategy, column, want in (("median", "a", 2.0), ("mode", "b", 5.0)):
        out = impute.imputer_stage([column], strategy).fit(df).transform(df)
        assert values(out, column)[-1] == want


def test_imputing_a_column_without_values_keeps_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert values(impute.impute_median(df, ["a"]), "a") == [None, None]


def test_listing_clean_up(spark):
    base = {name: 1 for name in LISTING_COLUMNS} | {"price": "$100.00", "room_type": "flat"}
    kept = [base, base | {"bedrooms": None}, base | {"bedrooms": 5}, base | {"bedrooms": 3}]
    gone = [base | {"price": p} for p in ("$0.00", "$250.00", "N/A", None)] + [base | {"minimum_nights": 366}]
    schema = ", ".join(
        f"{n} {'string' if n in ('price', 'room_type') else 'int'}" for n in [*LISTING_COLUMNS, "dropped"]
    )
    df = spark.createDataFrame([row | {"dropped": 0} for row in kept + gone], schema)
    out = clean_listings(df)
    assert out.columns == [*LISTING_COLUMNS, *[f"{n}_na" for n in IMPUTED_COLUMNS]]
    assert sorted((r["bedrooms"], r["bedrooms_na"]) for r in out.collect()) == [
        (1.0, 0.0),
        (3.0, 0.0),
        (3.0, 1.0),
        (5.0, 0.0),
    ]


def test_listing_clean_up_of_an_empty_table(spark):
    schema = ", ".join(f"{n} {'string' if n == 'price' else 'int'}" for n in LISTING_COLUMNS)
    assert clean_listings(spark.createDataFrame([], schema)).count() == 0


def test_unparsable_cast_does_not_stop_the_job(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(Exception):
        spark.sql("SELECT CAST('N/A' AS DOUBLE) AS x").collect()
