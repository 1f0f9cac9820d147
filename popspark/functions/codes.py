"""Fixed values of the source layouts and of the output vocabulary.

FIXED VALUES — these must equal the published layouts for right results.
They are stated plainly and in their natural order; everything that can be
built from a rule (column names, year windows) is built from one.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Output age bands, in order.
BANDS = ("0-19", "20-34", "35-49", "50-64", "65+")

# 1990/2000 age code 0..18 (0 = under one year, 1 = 1-4, 2 = 5-9 ... 18 = 85+):
# first code of each band.  2000 additionally uses 99 for the all-ages total.
# 2010/2020 age code 1..18 (1 = 0-4 ... 18 = 85+), 0 is the all-ages total.
# Both schemes end their bands at the same codes: 0-19 ends at 4, 20-34 at 7,
# 35-49 at 10, 50-64 at 13, 65+ at 18.
BAND_LAST_CODE = (4, 7, 10, 13, 18)

# 1970 race_sex code → (race, sex).  Codes 1..6; anything else is missing.
RACE_SEX_1970 = {
    1: ("White", "Male"),
    2: ("White", "Female"),
    3: ("Black", "Male"),
    4: ("Black", "Female"),
    5: ("Other", "Male"),
    6: ("Other", "Female"),
}

# 1990 race_sex code → (race, sex).  Odd codes male, even codes female.
RACE_SEX_1990 = {
    1: ("White", "Male"),
    2: ("White", "Female"),
    3: ("Black", "Male"),
    4: ("Black", "Female"),
    5: ("AIAN", "Male"),
    6: ("AIAN", "Female"),
    7: ("API", "Male"),
    8: ("API", "Female"),
}

# 1990 origin code: 1 = not Hispanic; any other non-missing code = Hispanic.
ORIGIN_NOT_HISPANIC = 1
ORIGIN_LABELS = ("NH", "Hispanic")

# 1990: the four Hispanic race cells summed into "H".
HISPANIC_RACES_1990 = ("AIAN", "API", "Black", "White")
HISPANIC_TOTAL_1990 = "H"

# 2000/2010/2020 race prefix → output label, in level order.
RACE_LEVELS_2000 = ("H", "NHWA", "NHBA", "NHAA", "NHIA", "NHNA", "NHTOM")
RACE_NAMES_2000 = ("Hispanic", "NH_White", "NH_Black", "NH_Asian", "NH_AIAN", "NH_NHPI", "NH_TOM")

# 2000/2010/2020: the fourteen population columns used, <race>_<SEX>.
WIDE_RACE_COLUMNS = (
    "NHWA_MALE", "NHWA_FEMALE", "NHBA_MALE", "NHBA_FEMALE",
    "NHIA_MALE", "NHIA_FEMALE", "NHAA_MALE", "NHAA_FEMALE",
    "NHNA_MALE", "NHNA_FEMALE", "NHTOM_MALE", "NHTOM_FEMALE",
    "H_MALE", "H_FEMALE",
)

# National rows.
US_FIPS = "00"
US_NAME = "United States"

# Missing-value tokens: 2010 adds "X" to the default "" and "NA".
NA_TOKENS_DEFAULT = ("", "NA")
NA_TOKENS_2010 = ("", "NA", "X")

# Highest state code kept in the state-name dimension (a string comparison).
MAX_STATE_CODE = "56"

# Postcensal windows per layout: (first kept YEAR code, last kept YEAR code,
# offset added to get the calendar year, all-ages AGEGRP code, age-code base).
WIDE_RACE_LAYOUTS = {
    2000: {"year_codes": (2, 11), "year_offset": 1998, "total_age": 99, "first_age_code": 0},
    2010: {"year_codes": (3, 12), "year_offset": 2007, "total_age": 0, "first_age_code": 1},
    2020: {"year_codes": (2, 6), "year_offset": 2018, "total_age": 0, "first_age_code": 1},
}

# 1990 two-digit year: calendar year = 1900 + code.
YEAR_OFFSET_1990 = 1900

# Source file names.  1990 has one file per year 1990..1999; 2000 has one
# file per two-digit state id 00..56 except the ids listed.
SOURCE_FILE_1970 = "co-asr-7079.csv"
SOURCE_FILE_1980 = "pe-02.csv"
SOURCE_FILE_1990 = "stch-icen{year}.txt"
SOURCE_FILE_2000 = "co-est00int-alldata-{state_id}.csv"
SOURCE_IDS_2000_UNUSED = ("00", "03", "07", "14", "43", "52")
SOURCE_FILE_2010 = "CC-EST2020-ALLDATA6.csv"
SOURCE_FILE_2020 = "cc-est2024-alldata.csv"
# ----------------------------------------------------------- END FIXED VALUES


def _age_columns_wide() -> tuple[str, ...]:
    """age0_4, age5_9, ..., age80_84, age85 — the 18 wide 1970/1980 columns."""
    names = [f"age{lo}_{lo + 4}" for lo in range(0, 85, 5)]
    return tuple(names + ["age85"])


WIDE_AGE_COLUMNS = _age_columns_wide()


def wide_age_band_members() -> dict[str, tuple[str, ...]]:
    """Band label → the wide age columns it sums (0-19 has four, 65+ five)."""
    out: dict[str, list[str]] = {b: [] for b in BANDS}
    for i, name in enumerate(WIDE_AGE_COLUMNS):
        # column i covers ages 5i..5i+4, i.e. 1-based age code i+1
        out[band_of_code(i + 1, first_age_code=1)].append(name)
    return {k: tuple(v) for k, v in out.items()}


def band_of_code(code: int, first_age_code: int) -> str | None:
    """Band label of an age code under the 0-based or 1-based scheme."""
    if code < first_age_code or code > BAND_LAST_CODE[-1]:
        return None
    for label, last in zip(BANDS, BAND_LAST_CODE):
        if code <= last:
            return label
    return None


WIDE_AGE_LAYOUT_COLUMNS = ("year", "fips", "race_sex") + WIDE_AGE_COLUMNS
# lines ahead of the 1980 data
PREAMBLE_LINES_1980 = 14
LONG_CODE_LAYOUT_COLUMNS = ("year", "fips", "age", "race_sex", "origin", "population")

# 1990 pivot columns: every origin × race label, missing labels spelt "NA"
# as the pivot names them.  Bounded: 3 origins × 5 races = 15 names.
def pivot_names_1990() -> tuple[str, ...]:
    origins = ORIGIN_LABELS + ("NA",)
    races = tuple(dict.fromkeys(r for r, _ in RACE_SEX_1990.values())) + ("NA",)
    seen: list[str] = []
    for o in origins:
        for r in races:
            name = f"{o}_{r}"
            if name not in seen:
                seen.append(name)
    return tuple(seen)


def source_manifest() -> dict[int, tuple[str, ...]]:
    """Expected source file names per decade (65 files in all)."""
    ids_2000 = [f"{i:02d}" for i in range(0, 57) if f"{i:02d}" not in SOURCE_IDS_2000_UNUSED]
    return {
        1970: (SOURCE_FILE_1970,),
        1980: (SOURCE_FILE_1980,),
        1990: tuple(SOURCE_FILE_1990.format(year=y) for y in range(1990, 2000)),
        2000: tuple(SOURCE_FILE_2000.format(state_id=i) for i in ids_2000),
        2010: (SOURCE_FILE_2010,),
        2020: (SOURCE_FILE_2020,),
    }


DECADES = (1970, 1980, 1990, 2000, 2010, 2020)
