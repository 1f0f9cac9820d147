"""DuckDB oracle SQL for every query in ``catalog.QUERIES``.

Written independently of the Spark plans and in the order the reproduced
pipeline works (unpivot, then aggregate county, then state), so the
Spark-side rewrites (aggregate-then-unpivot, fused county→state, pivot as
the aggregate) are checked, not assumed.  DuckDB ``sum`` returns HUGEINT, so
every sum is cast to BIGINT; missing-propagating sums are spelt
``CASE WHEN count(*) = count(x) THEN sum(x) END``.
"""

from __future__ import annotations

AGE_COLS = [f"age{lo}_{lo + 4}" for lo in range(0, 85, 5)] + ["age85"]
RACE_COLS = [
    "NHWA_MALE", "NHWA_FEMALE", "NHBA_MALE", "NHBA_FEMALE",
    "NHIA_MALE", "NHIA_FEMALE", "NHAA_MALE", "NHAA_FEMALE",
    "NHNA_MALE", "NHNA_FEMALE", "NHTOM_MALE", "NHTOM_FEMALE",
    "H_MALE", "H_FEMALE",
]


def strict(x: str) -> str:
    return f"CAST(CASE WHEN count(*) = count({x}) THEN sum({x}) END AS BIGINT)"


STATE_CODE = (
    "CASE WHEN c.c_nationkey >= 22 THEN CAST(c.c_nationkey + 38 AS VARCHAR) "
    "ELSE lpad(CAST(c.c_nationkey + 1 AS VARCHAR), 2, '0') END"
)
COUNTY_CODE = "lpad(CAST(c.c_custkey % 1000 AS VARCHAR), 3, '0')"

PERSONS = f"""
persons AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS cal_year,
         {STATE_CODE} AS state_code,
         {COUNTY_CODE} AS county_code,
         CAST(l.l_partkey % 19 AS INTEGER) AS age_code,
         CAST(l.l_partkey % 18 AS INTEGER) AS age_column,
         l.l_suppkey, l.l_linenumber, l.l_orderkey,
         (l.l_quantity = 49 AND l.l_linenumber = 7 AND l.l_returnflag = 'A') AS unmapped,
         CASE WHEN NOT (l.l_quantity = 50 AND l.l_linenumber = 7 AND l.l_returnflag = 'R')
              THEN CAST(l.l_quantity AS INTEGER) END AS population
  FROM lineitem l
  JOIN (orders o JOIN customer c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey
)"""

COUNTY_FIPS = f"""
county_fips AS (
  SELECT {STATE_CODE} AS state_code, n.n_name AS state_name, {COUNTY_CODE} AS county_code
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

NAMES = """
names AS (
  SELECT DISTINCT state_code AS state_fips, state_name FROM county_fips WHERE state_code <= '56'
)"""


def _one_hot(index: str, cols: list[str]) -> str:
    return ",\n         ".join(
        f"CASE WHEN {index} = {i} THEN population ELSE 0 END AS {c}" for i, c in enumerate(cols)
    )


V1970 = f"""
v1970 AS (
  SELECT cal_year AS year, state_code || county_code AS fips,
         CAST(CASE WHEN unmapped THEN 7 ELSE l_suppkey % 6 + 1 END AS INTEGER) AS race_sex,
         {_one_hot('age_column', AGE_COLS)}
  FROM persons
)"""

V1980 = f"""
v1980 AS (
  SELECT cal_year AS year,
         CASE WHEN substr(state_code, 1, 1) = '0' THEN substr(state_code || county_code, 2)
              ELSE state_code || county_code END AS fips,
         CASE l_suppkey % 6 + 1 WHEN 1 THEN 'White male' WHEN 2 THEN 'White female'
              WHEN 3 THEN 'Black male' WHEN 4 THEN 'Black female'
              WHEN 5 THEN 'Other races male' WHEN 6 THEN 'Other races female' END AS race_sex,
         {_one_hot('age_column', AGE_COLS)}
  FROM persons
  UNION ALL
  SELECT 1980, '1001', 'White male', 7, 8, {", ".join(["NULL"] * 16)}
  UNION ALL
  SELECT 1980, '10003', 'Black female', {", ".join(map(str, range(1, 19)))}
)"""

V1990 = """
v1990 AS (
  SELECT CAST(cal_year - 1900 AS INTEGER) AS year,
         CASE WHEN substr(state_code, 1, 1) = '0' THEN substr(state_code || county_code, 2)
              ELSE state_code || county_code END AS fips,
         age_code AS age,
         CAST(CASE WHEN unmapped THEN 9 ELSE l_suppkey % 8 + 1 END AS INTEGER) AS race_sex,
         CASE WHEN l_linenumber % 3 = 0 THEN 2 ELSE 1 END AS origin,
         population
  FROM persons
)"""


def _v_wide_race(decade: int) -> str:
    shift = {2000: 1994, 2010: 1993, 2020: 1993}[decade]
    if decade == 2000:
        agegrp = (
            "CASE WHEN l_linenumber = 6 AND l_orderkey % 3 = 0 THEN 99 "
            "WHEN l_linenumber = 6 AND l_orderkey % 3 = 1 THEN 25 ELSE age_code END"
        )
    else:
        agegrp = "age_code"
    return f"""
v{decade} AS (
  SELECT CAST(cal_year - {shift} AS INTEGER) AS "YEAR",
         CAST({agegrp} AS INTEGER) AS AGEGRP,
         state_code AS STATE, county_code AS COUNTY,
         {_one_hot('CAST((l_suppkey % 7) * 2 + (l_linenumber % 2) AS INTEGER)', RACE_COLS)}
  FROM persons
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = [PERSONS]
VIEWS = {1970: V1970, 1980: V1980, 1990: V1990, 2000: _v_wide_race(2000), 2010: _v_wide_race(2010), 2020: _v_wide_race(2020)}

# --------------------------------------------------------- recode snippets
# FIXED VALUES: code tables and labels, restated here in SQL on purpose; the
# oracle must not import the code that it checks.
BAND0 = (
    "CASE WHEN {c} BETWEEN 0 AND 4 THEN '0-19' WHEN {c} BETWEEN 5 AND 7 THEN '20-34' "
    "WHEN {c} BETWEEN 8 AND 10 THEN '35-49' WHEN {c} BETWEEN 11 AND 13 THEN '50-64' "
    "WHEN {c} BETWEEN 14 AND 18 THEN '65+' END"
)
BAND1 = BAND0.replace("BETWEEN 0 AND 4", "BETWEEN 1 AND 4")
SEX70 = "CASE WHEN race_sex IN (1, 3, 5) THEN 'Male' WHEN race_sex IN (2, 4, 6) THEN 'Female' END"
RACE70 = (
    "CASE WHEN race_sex IN (1, 2) THEN 'White' WHEN race_sex IN (3, 4) THEN 'Black' "
    "WHEN race_sex IN (5, 6) THEN 'Other' END"
)
SEX90 = "CASE WHEN race_sex IN (2, 4, 6, 8) THEN 'Female' WHEN race_sex IN (1, 3, 5, 7) THEN 'Male' END"
RACE90 = (
    "CASE WHEN race_sex IN (1, 2) THEN 'White' WHEN race_sex IN (3, 4) THEN 'Black' "
    "WHEN race_sex IN (5, 6) THEN 'AIAN' WHEN race_sex IN (7, 8) THEN 'API' END"
)
ORIGIN90 = "CASE WHEN origin = 1 THEN 'NH' WHEN origin IS NOT NULL THEN 'Hispanic' END"
TITLE = "upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"
LAST_WORD = "string_split({c}, ' ')[-1]"
FIRST_WORD = "string_split({c}, ' ')[1]"
PAD1 = "CASE WHEN length({c}) < 5 THEN '0' || {c} ELSE {c} END"
RACE2000 = (
    "CASE {c} WHEN 'H' THEN 'Hispanic' WHEN 'NHWA' THEN 'NH_White' WHEN 'NHBA' THEN 'NH_Black' "
    "WHEN 'NHAA' THEN 'NH_Asian' WHEN 'NHIA' THEN 'NH_AIAN' WHEN 'NHNA' THEN 'NH_NHPI' "
    "WHEN 'NHTOM' THEN 'NH_TOM' END"
)
BANDS_70 = {
    "0-19": ["age0_4", "age5_9", "age10_14", "age15_19"],
    "20-34": ["age20_24", "age25_29", "age30_34"],
    "35-49": ["age35_39", "age40_44", "age45_49"],
    "50-64": ["age50_54", "age55_59", "age60_64"],
    "65+": ["age65_69", "age70_74", "age75_79", "age80_84", "age85"],
}


def _band_sum(cols: list[str]) -> str:
    return " + ".join(f"CAST({c} AS BIGINT)" for c in cols)


# END FIXED VALUES
# --------------------------------------------------- per-layout state CTEs
def states_wide_age(decade: int) -> str:
    """1970/1980 state-level long table, as `states`."""
    if decade == 1970:
        fips, sex, race = "fips", SEX70, RACE70
    else:
        fips = PAD1.format(c="fips")
        sex = TITLE.format(c=LAST_WORD.format(c="race_sex"))
        race = FIRST_WORD.format(c="race_sex")
    long_parts = " UNION ALL ".join(
        f"SELECT year, substr({fips}, 1, 2) AS state_fips, {sex} AS sex, {race} AS race_p_ethnicity, "
        f"'{label}' AS age, {_band_sum(cols)} AS population FROM v{decade}"
        for label, cols in BANDS_70.items()
    )
    return f"""
long{decade} AS ({long_parts}),
states AS (
  SELECT year, state_fips, age, sex, race_p_ethnicity, {strict('population')} AS population
  FROM long{decade} GROUP BY year, state_fips, sex, race_p_ethnicity, age
)"""


def rec_1990() -> str:
    return f"""
rec90 AS (
  SELECT CAST(1900 + year AS INTEGER) AS year,
         substr({PAD1.format(c='fips')}, 1, 2) AS state_fips,
         {BAND0.format(c='age')} AS age,
         {SEX90} AS sex, {RACE90} AS race, {ORIGIN90} AS origin, population
  FROM v1990
),
cells90 AS (
  SELECT year, state_fips, age, sex,
         coalesce(origin, 'NA') || '_' || coalesce(race, 'NA') AS cell,
         {strict('population')} AS pop
  FROM rec90 GROUP BY year, state_fips, age, sex, origin, race
)"""


HISP = ("Hispanic_AIAN", "Hispanic_API", "Hispanic_Black", "Hispanic_White")
NS = "{a}.year IS NOT DISTINCT FROM {b}.year AND {a}.state_fips IS NOT DISTINCT FROM {b}.state_fips AND {a}.age IS NOT DISTINCT FROM {b}.age AND {a}.sex IS NOT DISTINCT FROM {b}.sex"


def states_1990() -> str:
    hisp = ", ".join(f"'{h}'" for h in HISP)
    return rec_1990() + f""",
keys90 AS (SELECT DISTINCT year, state_fips, age, sex FROM cells90),
present90 AS (SELECT DISTINCT cell FROM cells90 WHERE cell NOT IN ({hisp})),
dense90 AS (
  SELECT k.year, k.state_fips, k.age, k.sex, p.cell AS race_p_ethnicity, c.pop AS population
  FROM keys90 k CROSS JOIN present90 p
  LEFT JOIN cells90 c ON {NS.format(a='k', b='c')} AND c.cell = p.cell
),
h90 AS (
  SELECT k.year, k.state_fips, k.age, k.sex, 'H' AS race_p_ethnicity,
         CAST(CASE WHEN count(c.pop) = 4 THEN sum(c.pop) END AS BIGINT) AS population
  FROM keys90 k LEFT JOIN (SELECT * FROM cells90 WHERE cell IN ({hisp})) c ON {NS.format(a='k', b='c')}
  GROUP BY k.year, k.state_fips, k.age, k.sex
),
states AS (SELECT * FROM dense90 UNION ALL SELECT * FROM h90)"""


def rec_wide_race(decade: int) -> str:
    lo, hi, off, tot, band = {
        2000: (2, 11, 1998, 99, BAND0),
        2010: (3, 12, 2007, 0, BAND1),
        2020: (2, 6, 2018, 0, BAND1),
    }[decade]
    cols = ", ".join(RACE_COLS)
    return f"""
rec{decade} AS (
  SELECT CAST({off} + "YEAR" AS INTEGER) AS year, STATE, COUNTY, {band.format(c='AGEGRP')} AS age, {cols}
  FROM v{decade} WHERE "YEAR" BETWEEN {lo} AND {hi} AND AGEGRP <> {tot}
)"""


def long_wide_race(decade: int, src: str | None = None) -> str:
    src = src or f"rec{decade}"
    parts = " UNION ALL ".join(
        f"SELECT year, STATE, COUNTY, age, '{c.split('_')[0]}' AS rpe, '{c.split('_')[1]}' AS sex, "
        f"{c} AS population FROM {src}"
        for c in RACE_COLS
    )
    return f"\nlong{decade} AS ({parts})"


def county_wide_race(decade: int) -> str:
    return f"""
county{decade} AS (
  SELECT year, STATE, COUNTY, age, sex, rpe, {strict('population')} AS population
  FROM long{decade} GROUP BY year, STATE, COUNTY, age, sex, rpe
)"""


def states_wide_race(decade: int) -> str:
    return (
        rec_wide_race(decade)
        + ","
        + long_wide_race(decade)
        + ","
        + county_wide_race(decade)
        + f""",
states AS (
  SELECT year, STATE AS state_fips, age, {TITLE.format(c='sex')} AS sex, {RACE2000.format(c='rpe')} AS race_p_ethnicity,
         {strict('population')} AS population
  FROM county{decade} GROUP BY year, STATE, age, sex, rpe
)"""
    )


FINISH = f"""
named AS (
  SELECT s.year, s.state_fips, n.state_name, s.age, s.sex, s.race_p_ethnicity, s.population
  FROM states s LEFT JOIN names n ON s.state_fips IS NOT DISTINCT FROM n.state_fips
),
us AS (
  SELECT year, '00' AS state_fips, 'United States' AS state_name, age, sex, race_p_ethnicity,
         {strict('population')} AS population
  FROM named GROUP BY year, age, sex, race_p_ethnicity
),
result AS (
  SELECT year, state_fips, state_name, age, sex, race_p_ethnicity, population FROM named
  UNION ALL
  SELECT year, state_fips, state_name, age, sex, race_p_ethnicity, population FROM us
)"""


def states_cte(decade: int) -> str:
    if decade in (1970, 1980):
        return states_wide_age(decade)
    if decade == 1990:
        return states_1990()
    return states_wide_race(decade)


def decade_sql(decade: int, select: str = "SELECT * FROM result") -> str:
    return with_(PERSONS, COUNTY_FIPS, NAMES, VIEWS[decade], states_cte(decade), FINISH) + select


def all_decades_sql(select_decade: bool) -> str:
    parts = []
    for d in (1970, 1980, 1990, 2000, 2010, 2020):
        extra = f", {d} AS decade" if select_decade else ""
        parts.append(
            f"SELECT year, state_fips, state_name, age, sex, race_p_ethnicity, population{extra} FROM ({decade_sql(d)})"
        )
    return " UNION ALL ".join(parts)


# ------------------------------------------------------------------ queries
def _scan(decade: int, cols: str = "*") -> str:
    return with_(PERSONS, VIEWS[decade]) + f"SELECT {cols} FROM v{decade}"


WIDE_RACE_SCAN_COLS = '"YEAR", AGEGRP, STATE, COUNTY, ' + ", ".join(RACE_COLS)

PIVOT_CELLS = [
    f"{o}_{r}" for o in ("NH", "Hispanic", "NA") for r in ("White", "Black", "AIAN", "API", "NA")
]


def _pivot_1990_sql(select_cols: str) -> str:
    cols = ",\n  ".join(f"max(CASE WHEN cell = '{c}' THEN pop END) AS \"{c}\"" for c in PIVOT_CELLS)
    return with_(PERSONS, V1990, rec_1990()) + f"""
, wide AS (
  SELECT year, state_fips, age, sex,
  {cols}
  FROM cells90 GROUP BY year, state_fips, age, sex
)
SELECT {select_cols} FROM wide"""


BAND_RANK = "CASE age WHEN '0-19' THEN 1 WHEN '20-34' THEN 2 WHEN '35-49' THEN 3 WHEN '50-64' THEN 4 WHEN '65+' THEN 5 END"
RACE_PREFIX = (
    "CASE race_p_ethnicity WHEN 'Hispanic' THEN 'H' WHEN 'NH_White' THEN 'NHWA' WHEN 'NH_Black' THEN 'NHBA' "
    "WHEN 'NH_Asian' THEN 'NHAA' WHEN 'NH_AIAN' THEN 'NHIA' WHEN 'NH_NHPI' THEN 'NHNA' WHEN 'NH_TOM' THEN 'NHTOM' END"
)
RACE_LEVEL = (
    "CASE race_p_ethnicity WHEN 'Hispanic' THEN 1 WHEN 'NH_White' THEN 2 WHEN 'NH_Black' THEN 3 "
    "WHEN 'NH_Asian' THEN 4 WHEN 'NH_AIAN' THEN 5 WHEN 'NH_NHPI' THEN 6 WHEN 'NH_TOM' THEN 7 END"
)


def _export_sql(decade: int) -> str:
    """Position of each row inside its (national?, year) block of the export order."""
    if decade in (1970, 1980):
        rest = f"sex ASC NULLS LAST, race_p_ethnicity ASC NULLS LAST, {BAND_RANK} ASC NULLS LAST"
    elif decade == 1990:
        rest = (
            f"{BAND_RANK} ASC NULLS LAST, sex ASC NULLS LAST, "
            "CASE WHEN NOT is_us AND race_p_ethnicity = 'H' THEN 1 ELSE 0 END ASC, race_p_ethnicity ASC NULLS LAST"
        )
    else:
        rest = (
            f"{BAND_RANK} ASC NULLS LAST, sex ASC NULLS LAST, "
            f"CASE WHEN NOT is_us THEN {RACE_PREFIX} END ASC NULLS LAST, {RACE_LEVEL} ASC NULLS LAST"
        )
    select = f"""
SELECT year, state_fips, state_name, age, sex, race_p_ethnicity, population,
       CAST(row_number() OVER (PARTITION BY is_us, year ORDER BY state_fips ASC NULLS LAST, {rest}) AS INTEGER) AS position,
       {decade} AS decade
FROM (SELECT *, coalesce(state_fips = '00' AND state_name = 'United States', false) AS is_us FROM result)"""
    return f"SELECT * FROM ({decade_sql(decade, select)})"


def _violations_sql(decade: int) -> str:
    """Values outside their domain, with their counts, of one layout."""
    ok = {
        1970: {"year": "year IS NOT NULL", "fips": "length(fips) = 5", "race_sex": "race_sex BETWEEN 1 AND 6"},
        1980: {
            "year": "year IS NOT NULL",
            "fips": "length(fips) BETWEEN 4 AND 5",
            "race_sex": "race_sex LIKE '% %' AND lower(string_split(race_sex, ' ')[-1]) IN ('male', 'female')",
        },
        1990: {
            "year": "year IS NOT NULL",
            "fips": "length(fips) BETWEEN 3 AND 5",
            "age": "age BETWEEN 0 AND 18",
            "race_sex": "race_sex BETWEEN 1 AND 8",
            "origin": "origin IS NOT NULL",
        },
        2000: {"YEAR": '"YEAR" IS NOT NULL', "AGEGRP": "AGEGRP BETWEEN 0 AND 18 OR AGEGRP = 99", "STATE": "length(STATE) = 2"},
    }
    wide = ok[2000] | {"AGEGRP": "AGEGRP BETWEEN 0 AND 18"}
    parts = " UNION ALL ".join(
        f"""SELECT {decade} AS decade, '{c}' AS "column", CAST("{c}" AS VARCHAR) AS value, count(*) AS n_rows
  FROM v{decade} WHERE NOT coalesce({rule}, false) GROUP BY "{c}\""""
        for c, rule in ok.get(decade, wide).items()
    )
    return f"SELECT * FROM ({with_(PERSONS, VIEWS[decade])}{parts})"


def oracle_sql() -> dict[str, str]:
    band_sum_cols = ", ".join(
        f"{_band_sum(cols)} AS {alias}"
        for alias, cols in zip(["b0_19", "b20_34", "b35_49", "b50_64", "b65p"], BANDS_70.values())
    )
    q: dict[str, str] = {}
    q["scan_csv_headerless"] = _scan(1970)
    q["scan_csv_preamble"] = _scan(1980)
    q["scan_whitespace"] = _scan(1990)
    q["scan_csv_header"] = _scan(2000, WIDE_RACE_SCAN_COLS)
    q["scan_csv_missing_tokens"] = _scan(2010, WIDE_RACE_SCAN_COLS)
    q["scan_csv_header_80"] = _scan(2020, WIDE_RACE_SCAN_COLS)
    awkward = "state_name || ', \"' || state_fips || '\"'"
    q["lookup_scan"] = with_(COUNTY_FIPS, NAMES) + f"SELECT state_fips, {awkward} AS state_name FROM names"
    q["roundtrip_csv"] = decade_sql(1970, f"SELECT * REPLACE ({awkward} AS state_name) FROM result")
    audit = """
WITH present AS (
  SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows FROM lineitem
  UNION ALL SELECT 'orders.parquet', count(*) FROM orders
  UNION ALL SELECT 'customer.parquet', count(*) FROM customer
  UNION ALL SELECT 'nation.parquet', count(*) FROM nation
),
expected AS (
  SELECT * FROM (VALUES ('lineitem.parquet'), ('orders.parquet'), ('customer.parquet'),
                        ('nation.parquet'), ('state_names.parquet')) t(file_name)
)"""
    q["missing_sources"] = audit + """
SELECT file_name FROM expected WHERE file_name NOT IN (SELECT file_name FROM present WHERE n_rows > 0)"""
    q["source_completeness"] = audit + """
SELECT e.file_name, CAST(p.n_rows AS BIGINT) AS n_rows
FROM expected e LEFT JOIN (SELECT * FROM present WHERE n_rows > 0) p ON e.file_name = p.file_name"""
    q["filter_year_age"] = _scan(2000, WIDE_RACE_SCAN_COLS) + ' WHERE "YEAR" BETWEEN 2 AND 11 AND AGEGRP <> 99'
    q["filter_string_bound"] = with_(COUNTY_FIPS) + "SELECT * FROM county_fips WHERE state_code <= '56'"
    q["project_rename_reorder"] = (
        with_(PERSONS, VIEWS[2010], rec_wide_race(2010))
        + "SELECT year, STATE AS state_fips, COUNTY AS county_fips, age, "
        + ", ".join(RACE_COLS)
        + " FROM rec2010"
    )
    q["recode_sex"] = with_(PERSONS, V1970, V1990) + (
        f"SELECT 1970 AS decade, race_sex, {SEX70} AS sex FROM v1970 "
        f"UNION ALL SELECT 1990, race_sex, {SEX90} FROM v1990"
    )
    q["recode_race"] = with_(PERSONS, V1970, V1990) + (
        f"SELECT 1970 AS decade, race_sex, {RACE70} AS race FROM v1970 "
        f"UNION ALL SELECT 1990, race_sex, {RACE90} FROM v1990"
    )
    q["recode_origin"] = with_(PERSONS, V1990) + f"SELECT origin, {ORIGIN90} AS origin_label FROM v1990"
    q["split_words_title"] = with_(PERSONS, V1980) + (
        f"SELECT race_sex, {TITLE.format(c=LAST_WORD.format(c='race_sex'))} AS sex, "
        f"{FIRST_WORD.format(c='race_sex')} AS race_p_ethnicity FROM v1980"
    )
    q["pad_fips"] = with_(PERSONS, V1990) + (
        f"SELECT fips, {PAD1.format(c='fips')} AS fips5, CAST(length(fips) AS INTEGER) AS fips_length, "
        f"substr({PAD1.format(c='fips')}, 1, 2) AS state_fips FROM v1990"
    )
    q["year_offset"] = with_(PERSONS, V1990, _v_wide_race(2000), _v_wide_race(2010), _v_wide_race(2020)) + (
        'SELECT 2000 AS decade, "YEAR" AS code, CAST(1998 + "YEAR" AS INTEGER) AS year FROM v2000 '
        'UNION ALL SELECT 2010, "YEAR", CAST(2007 + "YEAR" AS INTEGER) FROM v2010 '
        'UNION ALL SELECT 2020, "YEAR", CAST(2018 + "YEAR" AS INTEGER) FROM v2020 '
        "UNION ALL SELECT 1990, year, CAST(1900 + year AS INTEGER) FROM v1990"
    )
    q["age_band_sums"] = with_(PERSONS, V1970) + f"SELECT year, fips, race_sex, {band_sum_cols} FROM v1970"
    q["age_band_collapse"] = with_(PERSONS, V1990, _v_wide_race(2000), _v_wide_race(2010)) + (
        f"SELECT '0-based' AS scheme, age AS code, {BAND0.format(c='age')} AS age_band FROM v1990 "
        f"UNION ALL SELECT '0-based', AGEGRP, {BAND0.format(c='AGEGRP')} FROM v2000 "
        f"UNION ALL SELECT '1-based', AGEGRP, {BAND1.format(c='AGEGRP')} FROM v2010"
    )
    q["race_label_map"] = (
        with_(PERSONS, VIEWS[2020], rec_wide_race(2020), long_wide_race(2020))
        + f"SELECT rpe, {RACE2000.format(c='rpe')} AS race_p_ethnicity, population FROM long2020"
    )
    q["hispanic_total"] = _pivot_1990_sql(
        'year, state_fips, age, sex, CAST("Hispanic_AIAN" AS BIGINT) + "Hispanic_API" + "Hispanic_Black" + "Hispanic_White" AS "H"'
    )
    q["unpivot_age"] = with_(PERSONS, V1970) + " UNION ALL ".join(
        f"SELECT year, fips, race_sex, '{label}' AS age, {_band_sum(cols)} AS population FROM v1970"
        for label, cols in BANDS_70.items()
    )
    q["unpivot_race_sex"] = (
        with_(PERSONS, VIEWS[2000], rec_wide_race(2000), long_wide_race(2000))
        + "SELECT year, STATE, COUNTY, age, rpe, sex, population FROM long2000"
    )
    q["unpivot_exclude"] = with_(PERSONS, V1990, states_1990()) + "SELECT * FROM states"
    q["pivot_origin_race"] = _pivot_1990_sql("*")
    q["agg_state"] = with_(PERSONS, V1970, states_wide_age(1970)) + "SELECT * FROM states"
    q["agg_county_band"] = (
        with_(PERSONS, VIEWS[2000], rec_wide_race(2000), long_wide_race(2000), county_wide_race(2000))
        + "SELECT * FROM county2000"
    )
    q["agg_county_to_state"] = with_(PERSONS, VIEWS[2000], states_wide_race(2000)) + "SELECT * FROM states"
    q["agg_national"] = decade_sql(2010, "SELECT * FROM us")
    q["agg_grouping_sets"] = with_(PERSONS, VIEWS[2010], states_wide_race(2010)) + f"""
SELECT year, state_fips, age, sex, race_p_ethnicity, population, false AS nation FROM states
UNION ALL
SELECT year, '00', age, sex, race_p_ethnicity, {strict('population')}, true FROM states GROUP BY year, age, sex, race_p_ethnicity"""
    q["strict_sum"] = with_(PERSONS, V1990, rec_1990()) + (
        f"SELECT year, state_fips, {strict('population')} AS population, "
        "CAST(sum(population) AS BIGINT) AS population_skipna, count(*) AS n_rows "
        "FROM rec90 GROUP BY year, state_fips"
    )
    q["join_state_names"] = decade_sql(2020, "SELECT s.*, n.state_name FROM states s LEFT JOIN names n ON s.state_fips IS NOT DISTINCT FROM n.state_fips")
    q["union_states_us"] = decade_sql(2000)
    q["union_decades"] = all_decades_sql(select_decade=False)
    q["distinct_states"] = with_(COUNTY_FIPS, NAMES) + "SELECT * FROM names ORDER BY state_fips NULLS LAST"
    q["domain_violations"] = " UNION ALL ".join(_violations_sql(d) for d in VIEWS)
    q["export_order"] = " UNION ALL ".join(_export_sql(d) for d in VIEWS)
    q["product_position"] = f"""
SELECT year, state_fips, state_name, age, sex, race_p_ethnicity, population, decade,
       row_number() OVER (ORDER BY decade, is_us, year ASC NULLS LAST, block_position) AS position
FROM (SELECT * EXCLUDE (position), position AS block_position,
             coalesce(state_fips = '00' AND state_name = 'United States', false) AS is_us
      FROM ({q["export_order"]}))"""
    q["scan_file_list"] = with_(*BASE, VIEWS[1990]) + "SELECT *, CAST(year % 10 AS VARCHAR) AS source_file FROM v1990"
    for d in (1970, 1980, 1990, 2000, 2010, 2020):
        q[f"pipeline_{d}"] = decade_sql(d)
    q["full_product"] = all_decades_sql(select_decade=True)
    return q
