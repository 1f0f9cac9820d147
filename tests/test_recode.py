"""Scalar recodes F1–F18 on literal inputs, NULL and out-of-domain included."""

from pyspark.sql import functions as F

from popspark.functions import codes, recode, strict_sum

from conftest import rows


def test_sex_race_1970_unmapped_is_null(spark):
    df = spark.createDataFrame([(c,) for c in (1, 2, 3, 4, 5, 6, 9, None)], "race_sex int")
    out = df.select(
        "race_sex",
        recode.sex_of("race_sex", codes.RACE_SEX_1970).alias("sex"),
        recode.race_of("race_sex", codes.RACE_SEX_1970).alias("race"),
    )
    got = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert got[1] == ("Male", "White") and got[2] == ("Female", "White")
    assert got[3] == ("Male", "Black") and got[6] == ("Female", "Other")
    assert got[9] == (None, None) and got[None] == (None, None)


def test_sex_race_1990(spark):
    df = spark.createDataFrame([(c,) for c in range(0, 10)], "race_sex int")
    out = df.select(
        "race_sex",
        recode.sex_of("race_sex", codes.RACE_SEX_1990).alias("sex"),
        recode.race_of("race_sex", codes.RACE_SEX_1990).alias("race"),
    )
    got = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert got[7] == ("Male", "API") and got[8] == ("Female", "API")
    assert got[5] == ("Male", "AIAN") and got[0] == (None, None) and got[9] == (None, None)


def test_origin_keeps_missing(spark):
    df = spark.createDataFrame([(1,), (2,), (7,), (None,)], "origin int")
    got = dict(df.select("origin", recode.origin_label("origin")).collect())
    assert got == {1: "NH", 2: "Hispanic", 7: "Hispanic", None: None}


def test_words_and_title(spark):
    df = spark.createDataFrame([("Other races female",), ("White MALE",)], "s string")
    out = df.select(
        recode.title_case(recode.last_word("s")).alias("sex"), recode.first_word("s").alias("race")
    )
    assert rows(out) == [("Female", "Other"), ("Male", "White")]


def test_pad_one_zero_not_lpad(spark):
    df = spark.createDataFrame([("101",), ("1001",), ("01001",), (None,)], "fips string")
    out = df.select("fips", recode.pad_one_zero("fips").alias("p"), recode.state_of_fips(recode.pad_one_zero("fips")).alias("s"))
    got = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert got["101"] == ("0101", "01")  # one zero only
    assert got["1001"] == ("01001", "01")
    assert got["01001"] == ("01001", "01")
    assert got[None] == (None, None)


def test_age_band_both_schemes(spark):
    df = spark.createDataFrame([(c,) for c in [0, 1, 4, 5, 7, 8, 10, 11, 13, 14, 18, 19, 99, None]], "c int")
    out = df.select("c", recode.age_band("c", 0).alias("b0"), recode.age_band("c", 1).alias("b1"))
    got = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert got[0] == ("0-19", None)  # 0 is a real age (<1) in 1990/2000, the total in 2010/2020
    assert got[4] == ("0-19", "0-19") and got[5] == ("20-34", "20-34")
    assert got[10] == ("35-49", "35-49") and got[11] == ("50-64", "50-64")
    assert got[14] == ("65+", "65+") and got[18] == ("65+", "65+")
    assert got[19] == (None, None) and got[99] == (None, None) and got[None] == (None, None)


def test_wide_age_band_members_partition_the_columns():
    m = codes.wide_age_band_members()
    assert list(m) == list(codes.BANDS)
    flat = [c for cols in m.values() for c in cols]
    assert flat == list(codes.WIDE_AGE_COLUMNS)
    assert m["0-19"] == ("age0_4", "age5_9", "age10_14", "age15_19")
    assert m["65+"] == ("age65_69", "age70_74", "age75_79", "age80_84", "age85")


def test_add_strict_null_propagates_and_is_bigint(spark):
    df = spark.createDataFrame([(2_000_000_000, 2_000_000_000, 1), (1, None, 1)], "a int, b int, c int")
    out = df.select(recode.add_strict(["a", "b", "c"]).alias("s"))
    assert out.schema["s"].dataType.simpleString() == "bigint"
    assert rows(out) == [(None,), (4_000_000_001,)]


def test_race_label_2000(spark):
    df = spark.createDataFrame([(c,) for c in codes.RACE_LEVELS_2000 + ("NHXX",)], "rpe string")
    got = dict(df.select("rpe", recode.race_label_2000("rpe")).collect())
    assert got["H"] == "Hispanic" and got["NHAA"] == "NH_Asian" and got["NHIA"] == "NH_AIAN"
    assert got["NHNA"] == "NH_NHPI" and got["NHTOM"] == "NH_TOM" and got["NHXX"] is None


def test_parse_int_tokens(spark):
    df = spark.createDataFrame([(v,) for v in ["5", " 05 ", "", "NA", "X", "1.5", "1e5", None]], "v string")
    got = dict(df.select("v", recode.parse_int("v", codes.NA_TOKENS_2010)).collect())
    assert got["5"] == 5 and got[" 05 "] == 5
    assert all(got[k] is None for k in ["", "NA", "X", "1.5", "1e5", None])


def test_strict_sum_vs_sum(spark):
    df = spark.createDataFrame([("a", 2), ("a", None), ("b", 3), ("b", 4)], "k string, v int")
    out = df.groupBy("k").agg(strict_sum("v").alias("strict"), F.sum("v").alias("skip"))
    assert rows(out) == [("a", None, 2), ("b", 7, 7)]


def test_year_from_code_never_overflows(spark):
    df = spark.createDataFrame([(90,), (2147483000,), (None,)], "y int")
    got = [r[0] for r in df.select(recode.year_from_code("y", 1900)).collect()]
    assert got == [1990, None, None]
