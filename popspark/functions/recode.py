"""Scalar recodes (F1–F18) as Column -> Column functions.

All are built-in expressions, so they stay inside whole-stage codegen.
Missing inputs and codes outside a domain map to NULL: every mapping is a
``when`` chain *without* ``otherwise``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql(v: object) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def code_map(c: Column | str, mapping: Mapping[object, str]) -> Column:
    """Map codes to labels; unmapped or NULL codes give NULL."""
    groups: dict[str, list[object]] = {}
    for code, label in mapping.items():
        groups.setdefault(label, []).append(code)
    if isinstance(c, str):  # one SQL CASE: a single round trip to build
        whens = " ".join(
            f"WHEN `{c}` IN ({', '.join(_sql(m) for m in members)}) THEN {_sql(label)}"
            for label, members in groups.items()
        )
        return F.expr(f"CASE {whens} END")
    expr = None
    for label, members in groups.items():
        cond = c.isin(*members)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def sex_of(c: Column | str, table: Mapping[int, tuple[str, str]]) -> Column:
    """race-sex code → 'Male' / 'Female'."""
    return code_map(c, {k: v[1] for k, v in table.items()})


def race_of(c: Column | str, table: Mapping[int, tuple[str, str]]) -> Column:
    """race-sex code → race label."""
    return code_map(c, {k: v[0] for k, v in table.items()})


def origin_label(c: Column | str) -> Column:
    """1 → 'NH', any other non-missing code → 'Hispanic', NULL stays NULL."""
    c = _col(c)
    nh, hisp = codes.ORIGIN_LABELS
    return F.when(c == codes.ORIGIN_NOT_HISPANIC, F.lit(nh)).when(c.isNotNull(), F.lit(hisp))


def last_word(c: Column | str) -> Column:
    """text after the last single space."""
    return F.element_at(F.split(_col(c), " "), -1)


def first_word(c: Column | str) -> Column:
    """text before the first single space."""
    return F.split(_col(c), " ").getItem(0)


def title_case(c: Column | str) -> Column:
    """'FEMALE' → 'Female', 'male' → 'Male'."""
    return F.initcap(F.lower(_col(c)))


def pad_one_zero(c: Column | str, width: int = 5) -> Column:
    """Prepend exactly one '0' when shorter than ``width`` ('101' → '0101')."""
    c = _col(c)
    return F.when(F.length(c) < width, F.concat(F.lit("0"), c)).otherwise(c)


def state_of_fips(c: Column | str) -> Column:
    """state code = first two characters of the county FIPS."""
    return F.substring(_col(c), 1, 2)


def year_from_code(c: Column | str, offset: int) -> Column:
    """calendar year = offset + code (integer).

    Added in BIGINT and narrowed with try_cast: a garbage code near the INT
    limit gives a missing year instead of an overflow failing the job.
    """
    return (F.lit(offset).cast("bigint") + _col(c).cast("bigint")).try_cast("int")


def add_strict(cols: Iterable[Column | str]) -> Column:
    """row-wise sum in BIGINT; NULL if any operand is NULL."""
    cols = list(cols)
    if all(isinstance(c, str) for c in cols):  # one SQL expression: one round trip to build
        return F.expr(" + ".join(f"CAST(`{c}` AS BIGINT)" for c in cols))
    cols = [_col(c).cast("bigint") for c in cols]
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def age_band(c: Column | str, first_age_code: int) -> Column:
    """F13+F14(+F16): age code → band label under the 0- or 1-based scheme.

    Codes outside first_age_code..18 (including a total code that was not
    filtered out) give NULL; the row itself is kept.
    """
    bounds = []
    lo = first_age_code
    for label, last in zip(codes.BANDS, codes.BAND_LAST_CODE):
        bounds.append((lo, last, label))
        lo = last + 1
    if isinstance(c, str):
        whens = " ".join(f"WHEN `{c}` BETWEEN {a} AND {b} THEN '{label}'" for a, b, label in bounds)
        return F.expr(f"CASE {whens} END")
    c = _col(c)
    expr = None
    for a, b, label in bounds:
        cond = c.between(a, b)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def band_rank(c: Column | str) -> Column:
    """Order of a band label (1..5), NULL for anything else (O2 ordering)."""
    c = _col(c)
    expr = None
    for i, label in enumerate(codes.BANDS, start=1):
        expr = F.when(c == label, F.lit(i)) if expr is None else expr.when(c == label, F.lit(i))
    return expr


def race_label_2000(c: Column | str) -> Column:
    """race prefix (H, NHWA, ...) → output label; unmapped → NULL."""
    return code_map(c, dict(zip(codes.RACE_LEVELS_2000, codes.RACE_NAMES_2000)))


def race_rank_2000(c: Column | str) -> Column:
    """Level order of a 2000+ race label (O2 ordering)."""
    c = _col(c)
    expr = None
    for i, label in enumerate(codes.RACE_NAMES_2000, start=1):
        expr = F.when(c == label, F.lit(i)) if expr is None else expr.when(c == label, F.lit(i))
    return expr


def na_to_null(c: Column | str, tokens: Iterable[str] = codes.NA_TOKENS_DEFAULT) -> Column:
    """Missing-value tokens (after trimming) → NULL; other text unchanged."""
    c = _col(c)
    return F.when(~F.coalesce(F.trim(c).isin(*tokens), F.lit(False)), c)


def parse_int(c: Column | str, tokens: Iterable[str] = codes.NA_TOKENS_DEFAULT) -> Column:
    """Text → INT; missing tokens and unparseable text (e.g. '1.5', 'X') → NULL."""
    return F.trim(na_to_null(c, tokens)).try_cast("int")
