"""Census-shaped inputs derived by Spark from the driver's tables.

The real population files are not reachable here, so every layout is
produced from ``lineitem ⋈ orders ⋈ customer``: one lineitem is one source
row ("a person-count record").  The derivation is a projection only — no
aggregation — so the pipelines, not the views, do all the grouping work,
and the work grows linearly with the tables.

Record rules (mirrored one-for-one by the DuckDB oracle SQL):

==============  =========================================================
calendar year   year(o_orderdate)
state code      nation+1 padded to 2 ('01'..'22'); nations 22-24 become
                territory codes '60'..'62' (above '56', so unnamed)
county code     c_custkey % 1000 padded to 3
age code        l_partkey % 19 (0..18)
population      int(l_quantity); NULL when quantity 50, line 7, flag 'R'
unmapped code   when quantity 49, line 7, flag 'A'
==============  =========================================================

Join order: ``orders ⋈ customer`` first (orders is a quarter of lineitem),
then lineitem; both are shuffle joins on their keys at scale, where AQE
splits a skewed key's partition.  Only the needed columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators.setops import shared_rows

# ------------------------------------------- TEST DATA (invented for the views)
# 1980 race-sex labels used to render the text layout (code 1..6).
RACE_SEX_LABELS_1980 = (
    "White male",
    "White female",
    "Black male",
    "Black female",
    "Other races male",
    "Other races female",
)
# 14 lines of prose ahead of the 1980 data.
PREAMBLE_1980 = tuple(f"Preamble line {i}: county population estimates by age, sex and race" for i in range(1, 15))
# Lines of the 1980 file that the reader must tell apart: a title line of 21
# fields (dropped), a row that ends early, and a row with quoted fields.
TITLE_1980 = ",".join(codes.WIDE_AGE_LAYOUT_COLUMNS)
SHORT_ROW_1980 = "1980,1001,White male,7,8"
QUOTED_ROW_1980 = '"1980","10003","Black female",' + ",".join(str(i) for i in range(1, 19))
# ------------------------------------------------------------- END TEST DATA

TERRITORY_FROM_NATION = 22  # nations >= 22 get codes 60, 61, 62


# Declared schemas of the driver tables the views read.  Declaring them
# (as the source layouts are declared) skips Spark's schema-discovery job
# per read — one job per table per query otherwise.
TABLE_SCHEMAS = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def state_code_sql(nationkey: str) -> str:
    """State code of a nation key column, as a SQL expression."""
    n = nationkey
    return (
        f"CASE WHEN {n} >= {TERRITORY_FROM_NATION} THEN CAST({n} + 38 AS STRING) "
        f"ELSE lpad(CAST({n} + 1 AS STRING), 2, '0') END"
    )


def county_code_sql(custkey: str) -> str:
    return f"lpad(CAST({custkey} % 1000 AS STRING), 3, '0')"


def state_code(nationkey: str) -> Column:
    return F.expr(state_code_sql(nationkey))


def county_code(custkey: str) -> Column:
    return F.expr(county_code_sql(custkey))


MISSING_POP = "l_quantity = 50 AND l_linenumber = 7 AND l_returnflag = 'R'"
UNMAPPED = "l_quantity = 49 AND l_linenumber = 7 AND l_returnflag = 'A'"


PERSON_COLUMNS = (
    "cal_year",
    "state_code",
    "county_code",
    "age_code",
    "age_column",
    "l_suppkey",
    "l_linenumber",
    "l_orderkey",
    "unmapped",
    "population",
)


def person_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with the derived census keys.

    Lineitem-side codes are computed *before* the join so the shuffled rows
    carry small ints instead of the raw columns.  lineitem and
    orders ⋈ customer both grow with the data, so that join is declared a
    shuffle (sort-merge) join rather than left to size estimates, which
    without statistics can pick the larger side to broadcast.
    """
    li = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "CAST(l_partkey % 19 AS INT) AS age_code",
        "CAST(l_partkey % 18 AS INT) AS age_column",
        "l_suppkey",
        "l_linenumber",
        f"({UNMAPPED}) AS unmapped",
        f"CASE WHEN NOT ({MISSING_POP}) THEN CAST(l_quantity AS INT) END AS population",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = orders.join(cust, F.expr("o_custkey = c_custkey"), "inner").selectExpr(
        "o_orderkey",
        "CAST(year(o_orderdate) AS INT) AS cal_year",
        f"{state_code_sql('c_nationkey')} AS state_code",
        f"{county_code_sql('c_custkey')} AS county_code",
    )
    base = li.join(oc.hint("merge"), F.expr("l_orderkey = o_orderkey"), "inner")
    return base.select(*PERSON_COLUMNS)


def shared_person_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``person_records`` for queries over several decades: the join runs once, and all read its result.

    The joined rows are dealt out by a shuffle that every decade reuses, so
    none sorts and merges the tables again.  (Order, line) spreads evenly,
    whatever key is hot in the join.
    """
    return shared_rows(person_records(spark, sf_dir), "l_orderkey", "l_linenumber")


def county_fips_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 stand-in: a county-level code table (state_code, state_name, county_code).

    One row per customer, so state codes repeat many times (as in a real
    county table) and the dimension needs D1's distinct.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "inner")
    return j.select(
        state_code("c_nationkey").alias("state_code"),
        F.col("n_name").alias("state_name"),
        county_code("c_custkey").alias("county_code"),
    )


FIPS = "concat(state_code, county_code)"
# one leading zero stripped (a 4-digit FIPS for states 01-09)
FIPS_ONE_ZERO_STRIPPED = (
    "CASE WHEN substr(state_code, 1, 1) = '0' THEN substr(concat(state_code, county_code), 2) "
    "ELSE concat(state_code, county_code) END"
)


def _one_hot(index: str, names: tuple[str, ...], value: str = "population") -> list[str]:
    """One SQL column per name: ``value`` where ``index`` == its position, else 0 (a sparse wide row)."""
    return [f"CASE WHEN {index} = {i} THEN {value} ELSE 0 END AS {n}" for i, n in enumerate(names)]


RACE_SEX = {
    1970: "CASE WHEN unmapped THEN 7 ELSE CAST(l_suppkey % 6 + 1 AS INT) END",
    1990: "CASE WHEN unmapped THEN 9 ELSE CAST(l_suppkey % 8 + 1 AS INT) END",
}


def year_sql(decade: int) -> str:
    """The year as the layout codes it: two digits in 1990, a YEAR code from 2000 on."""
    return f"CAST(cal_year - {1900 if decade == 1990 else WIDE_RACE_YEAR_SHIFT[decade]} AS INT)"


def age_sql(decade: int) -> str:
    """The layout's age code; 2000 also has total rows (99) and a code outside the domain."""
    if decade != 2000:
        return "age_code"
    return (
        "CAST(CASE WHEN l_linenumber = 6 AND l_orderkey % 3 = 0 THEN 99 "
        "WHEN l_linenumber = 6 AND l_orderkey % 3 = 1 THEN 25 ELSE age_code END AS INT)"
    )


def layout_codes(spark: SparkSession, sf_dir: str, code_sql: Mapping[int, str]) -> DataFrame:
    """(decade, code): every record once per layout, with the layout's code.

    The tables are joined once for all layouts.  A union of views would sort
    and merge them for each, and AQE would make each join's tasks larger, as
    it deals the least number of tasks out to the union's parts.
    """
    entries = [f"struct({d} AS decade, {sql} AS code)" for d, sql in code_sql.items()]
    return person_records(spark, sf_dir).selectExpr(f"inline(array({', '.join(entries)}))")


def wide_age_1970(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """1970 layout (typed): year, fips, race_sex int, 18 age columns."""
    return (base or person_records(spark, sf_dir)).selectExpr(
        "cal_year AS year",
        f"{FIPS} AS fips",
        f"{RACE_SEX[1970]} AS race_sex",
        *_one_hot("age_column", codes.WIDE_AGE_COLUMNS),
    )


def wide_age_1980(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """1980 layout (typed): as 1970, race_sex is a text label, state zero stripped."""
    labels = ", ".join(f"'{x}'" for x in RACE_SEX_LABELS_1980)
    return (base or person_records(spark, sf_dir)).selectExpr(
        "cal_year AS year",
        f"{FIPS_ONE_ZERO_STRIPPED} AS fips",
        f"element_at(array({labels}), CAST(l_suppkey % 6 + 1 AS INT)) AS race_sex",
        *_one_hot("age_column", codes.WIDE_AGE_COLUMNS),
    )


def long_codes_1990(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """1990 layout (typed): two-digit year, fips, age 0..18, race_sex, origin, population."""
    return (base or person_records(spark, sf_dir)).selectExpr(
        f"{year_sql(1990)} AS year",
        f"{FIPS_ONE_ZERO_STRIPPED} AS fips",
        f"{age_sql(1990)} AS age",
        f"{RACE_SEX[1990]} AS race_sex",
        "CASE WHEN l_linenumber % 3 = 0 THEN 2 ELSE 1 END AS origin",
        "population",
    )


# YEAR code = calendar year - k: 2000 gets codes 1..7 (1 dropped),
# 2010 and 2020 codes 2..8 (2 dropped for 2010; 7, 8 dropped for 2020).
WIDE_RACE_YEAR_SHIFT = {2000: 1994, 2010: 1993, 2020: 1993}


def wide_race(spark: SparkSession, sf_dir: str, decade: int, base: DataFrame | None = None) -> DataFrame:
    """2000/2010/2020 layout (typed): YEAR, AGEGRP, STATE, COUNTY + 14 counts.

    2000 also carries total rows (AGEGRP 99) and an out-of-domain age code.
    """
    cell = "CAST((l_suppkey % 7) * 2 + (l_linenumber % 2) AS INT)"
    return (base or person_records(spark, sf_dir)).selectExpr(
        f"{year_sql(decade)} AS YEAR",
        f"{age_sql(decade)} AS AGEGRP",
        "state_code AS STATE",
        "county_code AS COUNTY",
        *_one_hot(cell, codes.WIDE_RACE_COLUMNS),
    )


# -------------------------------------------------------------- text layouts
WIDE_AGE_TEXT_COLUMNS = codes.WIDE_AGE_LAYOUT_COLUMNS

def _txt(c: Column, na: str = "NA") -> Column:
    return F.coalesce(c.cast("string"), F.lit(na))


def lines_1970(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-less CSV lines of the 1970 layout; missing written as NA."""
    w = wide_age_1970(spark, sf_dir)
    line = F.concat_ws(",", *[_txt(F.col(c)) for c in WIDE_AGE_TEXT_COLUMNS])
    return w.select(line.alias("value"), F.lit(False).alias("skip"))


def lines_1980(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """1980 lines with their numbers: prose and a title line first, blank lines between data lines, a short and a quoted row."""
    w = wide_age_1980(spark, sf_dir, base)
    line = F.concat_ws(",", *[_txt(F.col(c)) for c in WIDE_AGE_TEXT_COLUMNS])
    # a blank line after every row whose state code ends in 5 (no shuffle)
    with_blank = F.when(F.substring(F.col("fips"), 2, 1) == "5", F.array(line, F.lit(""))).otherwise(F.array(line))
    own = (*PREAMBLE_1980[1:], TITLE_1980, "", SHORT_ROW_1980, QUOTED_ROW_1980)
    number = F.lit(len(own) + 1) + F.monotonically_increasing_id()
    data = w.select(F.explode(with_blank).alias("value")).select("value", number.alias("line"))
    head = [(x, i + 1) for i, x in enumerate(own)]
    return spark.createDataFrame(head, "value string, line long").unionByName(data)


def lines_1990(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitespace-separated lines with varying padding, as fixed-width text."""
    w = long_codes_1990(spark, sf_dir)
    fields = [
        F.lpad(_txt(F.col("year")), 3, " "),
        F.lpad(_txt(F.col("fips")), 6, " "),
        F.lpad(_txt(F.col("age")), 3, " "),
        _txt(F.col("race_sex")),
        _txt(F.col("origin")),
        F.lpad(_txt(F.col("population")), 7, " "),
    ]
    return w.select(F.concat_ws(" ", *fields).alias("value"), F.lit(False).alias("skip"))


def wide_race_columns(decade: int) -> tuple[str, ...]:
    """Text header of the wide-race layout: used columns plus unused fillers (80 columns in 2020)."""
    used = ("STATE", "COUNTY", "YEAR", "AGEGRP") + codes.WIDE_RACE_COLUMNS
    if decade == 2020:
        return ("x1", *used, *(f"x{i}" for i in range(2, 81 - len(used))))
    return ("x1", *used, "x2")


def lines_wide_race(spark: SparkSession, sf_dir: str, decade: int) -> DataFrame:
    """CSV lines of the wide-race layout plus the header line (flagged ``skip``);
    2010 writes 'X' for missing."""
    w = wide_race(spark, sf_dir, decade)
    na = "X" if decade == 2010 else "NA"
    cols = wide_race_columns(decade)
    filler = lambda c: F.lit("050" if c == "x1" else "0")
    body = w.select(
        F.concat_ws(",", *[filler(c) if c.startswith("x") else _txt(F.col(c), na) for c in cols]).alias("value"),
        F.lit(False).alias("skip"),
    )
    header = spark.createDataFrame([(",".join(cols), True)], "value string, skip boolean")
    return header.unionByName(body)
