"""Invented source files in the six layouts (FIXTURES.md), written under a temp root."""

from __future__ import annotations

import os

from popspark.functions import codes

from conftest import write

ROWS_1970 = [
    "1970,01001,1,1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18",
    "1970,01003,2,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1",
    "1970,02001,9,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1",
    "1970,02003,3,NA,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1",
]

PREAMBLE_1980 = [f"Note {i}: estimates of the resident population, prepared for testing" for i in range(1, 15)]
ROWS_1980 = [
    "1980,1001,White male,1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18",
    "",
    "1980,10001,Other races female,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1,1",
]

# year fips age race_sex origin population; all four Hispanic races appear
# somewhere, but (01, 0-19, Male) lacks Hispanic AIAN/API/Black → its H is NULL.
ROWS_1990 = [
    "90 01001  0 1 1    239",
    "90  1001  1 1 2     12",
    "90 101   18 8 1      5",
    "90 02001 18 6 2      3",
    "90 02001 18 8 2      4",
    "90 02001 18 4 2      6",
    "90 02001 18 2 2      7",
]

WIDE_RACE_USED = ["YEAR", "AGEGRP", "STATE", "COUNTY"] + list(codes.WIDE_RACE_COLUMNS)


def wide_race_header(n_unused: int) -> list[str]:
    """x1, x2, the 18 used columns, then x3..xN: used columns are found by name."""
    return ["x1", "x2"] + WIDE_RACE_USED + [f"x{i}" for i in range(3, n_unused + 1)]


def wide_race_line(header, **vals) -> str:
    return ",".join(str(vals.get(h, 0)) for h in header)


def counts(v):
    return {c: v for c in codes.WIDE_RACE_COLUMNS}


def rows_2000(header):
    base = {"STATE": "01", "COUNTY": "001"}
    return [
        wide_race_line(header, YEAR=1, AGEGRP=1, **base, **counts(100)),  # dropped: YEAR 1
        wide_race_line(header, YEAR=2, AGEGRP=0, **base, **counts(1)),  # kept: age 0 is <1 year
        wide_race_line(header, YEAR=2, AGEGRP=5, **base, **counts(2)),
        wide_race_line(header, YEAR=2, AGEGRP=5, STATE="01", COUNTY="003", **counts(3)),
        wide_race_line(header, YEAR=2, AGEGRP=99, **base, **counts(1000)),  # dropped: total
        wide_race_line(header, YEAR=11, AGEGRP=18, STATE="56", COUNTY="001", **counts(4)),
        wide_race_line(header, YEAR=12, AGEGRP=18, **base, **counts(100)),  # dropped: YEAR 12
    ]


def rows_2010(header):
    x = counts(5)
    x["H_MALE"] = "X"
    return [
        wide_race_line(header, YEAR=2, AGEGRP=1, STATE="01", COUNTY="001", **counts(100)),  # dropped
        wide_race_line(header, YEAR=3, AGEGRP=1, STATE="01", COUNTY="001", **x),
        wide_race_line(header, YEAR=3, AGEGRP=1, STATE="02", COUNTY="001", **counts(6)),
        wide_race_line(header, YEAR=3, AGEGRP=0, STATE="01", COUNTY="001", **counts(1000)),  # total
        wide_race_line(header, YEAR=12, AGEGRP=18, STATE="02", COUNTY="005", **counts(7)),
        wide_race_line(header, YEAR=13, AGEGRP=18, STATE="02", COUNTY="005", **counts(100)),  # dropped
    ]


def rows_2020(header):
    return [
        wide_race_line(header, YEAR=1, AGEGRP=4, STATE="01", COUNTY="001", **counts(100)),  # dropped
        wide_race_line(header, YEAR=2, AGEGRP=4, STATE="01", COUNTY="001", **counts(8)),
        wide_race_line(header, YEAR=6, AGEGRP=14, STATE="01", COUNTY="001", **counts(9)),
        wide_race_line(header, YEAR=6, AGEGRP=0, STATE="01", COUNTY="001", **counts(1000)),  # total
        wide_race_line(header, YEAR=7, AGEGRP=4, STATE="01", COUNTY="001", **counts(100)),  # dropped
    ]


H2000 = wide_race_header(32)
H2020 = wide_race_header(62)


def build_source_tree(root: str) -> str:
    """All 65 expected files under root/<decade>/ (2000's rows go in one of its 51 files)."""
    m = codes.source_manifest()
    write(os.path.join(root, "1970", m[1970][0]), "\n".join(ROWS_1970) + "\n")
    write(os.path.join(root, "1980", m[1980][0]), "\n".join(PREAMBLE_1980 + ROWS_1980) + "\n")
    for i, f in enumerate(m[1990]):
        body = ROWS_1990 if i == 0 else [f"9{i} 01001  5 1 1      1"]
        write(os.path.join(root, "1990", f), "\n".join(body) + "\n")
    for i, f in enumerate(m[2000]):
        # every file has data; what the other files hold is out of the year range
        body = rows_2000(H2000) if i == 0 else rows_2000(H2000)[:1]
        write(os.path.join(root, "2000", f), "\n".join([",".join(H2000)] + body) + "\n")
    write(os.path.join(root, "2010", m[2010][0]), "\n".join([",".join(H2000)] + rows_2010(H2000)) + "\n")
    write(os.path.join(root, "2020", m[2020][0]), "\n".join([",".join(H2020)] + rows_2020(H2020)) + "\n")
    return root


COUNTY_TABLE = [("01", "Alabama", "001"), ("01", "Alabama", "003"), ("02", "Alaska", "001"),
                ("56", "Wyoming", "001"), ("60", "American Samoa", "010")]
