"""Readers for the six source layouts.

Each layout has two entry points sharing one typing step:

* ``read_*(spark, paths)`` — files, via Spark's CSV/text sources (splittable
  for plain text; gzip inputs are not, repartition after such a read);
* ``parse_*(lines)`` — a DataFrame with one ``value`` string column per
  source line, via ``from_csv`` / ``split``; used where lines are derived by
  Spark from other tables, and to test parsing without files.

Integer fields of CSV files are parsed natively with a declared schema
(PERMISSIVE: a malformed or missing-token field becomes NULL, the rest of
the row is kept); text fields keep their leading zeros and have their
missing tokens mapped to NULL.  Line parsers read every field as text and
type it with ``try_cast``, with identical results.  Nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import CANONICAL
from ..functions import codes
from ..functions.recode import na_to_null, parse_int


# ------------------------------------------------------------------ typing
def _int(df: DataFrame, name: str, tokens) -> Column:
    """INT column ``name``: passed through when the scan already typed it, else parsed.

    A pass-through is returned *without* an alias: a column aliased to its
    own name makes otherwise identical branches canonicalize differently,
    which stops Spark from reusing the state-aggregate exchange between the
    state and national branches.
    """
    if df.schema[name].dataType == T.IntegerType():
        return F.col(name)
    return parse_int(name, tokens).alias(name)


def _text(name: str, tokens) -> Column:
    return na_to_null(F.trim(F.col(name)), tokens)


def type_wide_age(df: DataFrame, race_sex_is_text: bool, tokens=codes.NA_TOKENS_DEFAULT) -> DataFrame:
    """1970 (race_sex int) / 1980 (race_sex text) wide-age layout, typed."""
    race_sex = _text("race_sex", tokens).alias("race_sex") if race_sex_is_text else _int(df, "race_sex", tokens)
    return df.select(
        _int(df, "year", tokens),
        _text("fips", tokens).alias("fips"),
        race_sex,
        *[_int(df, c, tokens) for c in codes.WIDE_AGE_COLUMNS],
    )


def type_long_codes(df: DataFrame, tokens=codes.NA_TOKENS_DEFAULT, keep: Sequence[str] = ()) -> DataFrame:
    """1990 long-code layout, typed (fips stays text), and the columns ``keep`` as they are."""
    return df.select(
        _int(df, "year", tokens),
        na_to_null(F.col("fips"), tokens).alias("fips"),
        *[_int(df, c, tokens) for c in ("age", "race_sex", "origin", "population")],
        *keep,
    )


def type_wide_race(df: DataFrame, tokens=codes.NA_TOKENS_DEFAULT) -> DataFrame:
    """2000/2010/2020 layout: select the used columns by name and type them."""
    return df.select(
        _int(df, "YEAR", tokens),
        _int(df, "AGEGRP", tokens),
        _text("STATE", tokens).alias("STATE"),
        _text("COUNTY", tokens).alias("COUNTY"),
        *[_int(df, c, tokens) for c in codes.WIDE_RACE_COLUMNS],
    )


def declared_schema(names: Sequence[str], int_columns: Sequence[str], record: bool = False) -> T.StructType:
    """All columns text except ``int_columns`` (the ones the layout declares integer); with ``record``, the text of a record that can't be typed."""
    ints = set(int_columns)
    fields = [T.StructField(n, T.IntegerType() if n in ints else T.StringType(), True) for n in names]
    return T.StructType([*fields, *([T.StructField(RECORD, T.StringType())] if record else [])])


# ------------------------------------------------------------ parse problems
FILE, RECORD = "__file", "__record"


class Problems:
    """How many fields that aren't missing can't be read as the integers they should be.

    Such a field becomes NULL and nulls every strict sum over it.  The counts,
    per file and column, are observed by the scan that computes the result.
    An observation holds one value per metric, so each column's metric is a
    histogram over the numbers of the files, with more bins than there are
    files (at most the manifest's 51 in a decade); it is exact.
    """

    def __init__(self, paths: Sequence[str] | str):
        self.files = sorted({p.rsplit("/", 1)[-1] for p in ([paths] if isinstance(paths, str) else paths)})
        self.seen = Observation()

    def observe(self, rows: DataFrame, ints: Sequence[str], text: Callable[[str], Column], tokens: Sequence[str]) -> DataFrame:
        """``rows``, observed; ``text`` gives a column's text, NULL where it is known to be fine."""
        number = F.array_position(F.array(*map(F.lit, self.files)), F.col(FILE)).cast("double")
        bins = F.lit(2 * len(self.files) + 2)

        def bad(name: str) -> Column:
            return text(name).isNotNull() & na_to_null(F.trim(text(name)), tokens).isNotNull() & parse_int(text(name), tokens).isNull()

        return rows.observe(self.seen, *(F.histogram_numeric(F.when(bad(c), number), bins).alias(c) for c in ints))

    def counts(self) -> list[tuple[str, str, int]]:
        """(file, column, fields); to be called once the result is computed."""
        out: dict[tuple[str, str], int] = {}
        for column, found in self.seen.get.items():
            for x, y in found or ():
                key = self.files[round(x) - 1], column
                out[key] = out.get(key, 0) + round(y)
        return sorted((*k, n) for k, n in out.items())


# ------------------------------------------------------- line-based parsers
def data_lines(lines: DataFrame, is_data: Column) -> DataFrame:
    """The data lines of ``lines`` (one ``value`` column per source line).

    Lines produced by Spark from other tables may carry a boolean ``skip``
    column (header, preamble or blank lines), set where they are produced.
    That flag is used when present.  Otherwise the layout's text predicate
    ``is_data`` decides.  On derived lines, Catalyst would push that predicate
    below the projection that builds ``value`` and build every line twice.
    """
    if "skip" in lines.columns:
        return lines.filter(~F.col("skip")).select("value")
    return lines.filter(is_data)


def _texts(names: Sequence[str], record: Column, only_if: Column) -> Column:
    """The fields of a CSV record as text, read again where it is worth a look."""
    return F.when(only_if, _from_csv(record, names))


def _from_csv(value: Column, names: Sequence[str], int_columns: Sequence[str] = ()) -> Column:
    ints = set(int_columns)
    ddl = ", ".join(f"`{n}` {'INT' if n in ints else 'STRING'}" for n in names)
    return F.from_csv(value, ddl, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})


def parse_wide_age_lines(lines: DataFrame, race_sex_is_text: bool = False, problems: Problems | None = None) -> DataFrame:
    """S1 on lines: header-less CSV, 21 positional fields; blank lines skipped."""
    names = codes.WIDE_AGE_LAYOUT_COLUMNS
    ints = ("year",) + (() if race_sex_is_text else ("race_sex",)) + codes.WIDE_AGE_COLUMNS
    body = data_lines(lines, F.length(F.trim(F.col("value"))) > 0)
    fields = _from_csv(F.col("value"), names, ints).alias("r")
    if problems:
        rec = body.select(FILE, "value", fields)
        gap = F.greatest(*(F.col(f"r.{c}").isNull() for c in ints))  # a field is missing, or can't be read
        rec = rec.select(FILE, "r.*", _texts(names, F.col("value"), gap).alias(RECORD))
        rec = problems.observe(rec, ints, lambda c: F.col(f"{RECORD}.{c}"), codes.NA_TOKENS_DEFAULT)
    else:
        rec = body.select(fields).select("r.*")
    return type_wide_age(rec, race_sex_is_text)


_FIPS = r'\s*("\d{4,5}"|\d{4,5})\s*(,|$)'


def is_data_line_1980(value: Column) -> Column:
    """Whether a 1980 line looks like data: it leads with a four-digit year, bare or quoted, or with a missing year and a FIPS code; a row may be short.

    Where line numbers are known, they decide what is data, and this only
    checks them; title and prose lines don't start so.
    """
    return value.rlike(r'^\s*("\d{4}"|\d{4})\s*(,|$)') | value.rlike(r'^\s*(""|NA|"NA")?\s*,' + _FIPS)


def parse_preamble_lines(lines: DataFrame, preamble: int = codes.PREAMBLE_LINES_1980, problems: Problems | None = None) -> DataFrame:
    """S2 on lines: drop the preamble and blank lines, then as S1 with text race_sex.

    With a ``line`` column (the number of the line in its file, from 1), the
    first ``preamble`` lines are dropped whatever they hold, and every later
    one is a row.  Without it, a line is a row if it looks like one.  A short
    row keeps its fields; the missing ones are NULL, as in S1.
    """
    value = F.col("value")
    is_data = (F.col("line") > preamble) & (F.length(F.trim(value)) > 0) if "line" in lines.columns else is_data_line_1980(value)
    return parse_wide_age_lines(data_lines(lines, is_data), race_sex_is_text=True, problems=problems)


def numbered_lines(spark: SparkSession, paths, first: int) -> DataFrame:
    """(value, line, __file: the file's name) of text files: exact line numbers up to ``first``, and above it for every later line.

    A file is read in splits by many tasks, so nobody sees a line's number.
    Each split's lines are counted, the counts are added up over the splits
    before it (``_metadata.file_block_start``), and a split's lines are
    numbered from that sum on.  Only splits that begin within the first
    ``first`` lines need their sum, at most ``first`` of each file: a job of
    its own counts lines (it reads no fields) and brings those to the driver.
    A line of any other split is far behind and numbered ``first`` + 1.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_name").alias(FILE),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    )
    splits = lines.groupBy("__path", "__start").agg(F.min("__id").alias("__from"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__path").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    head = splits.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).filter(F.col("__before") < first)
    known = spark.createDataFrame(head.drop("__n").collect(), "__path string, __start long, __from long, __before long")
    numbered = lines.join(F.broadcast(known), ["__path", "__start"], "left")
    number = F.col("__id") - F.col("__from") + F.col("__before") + 1
    return numbered.select("value", F.coalesce(number, F.lit(first + 1)).alias("line"), FILE)


REJECTED, ROW_LIKE = "rejected_lines", "row_like_lines"


def observe_rejected(lines: DataFrame, seen: Observation, preamble: int = codes.PREAMBLE_LINES_1980) -> DataFrame:
    """Numbered 1980 ``lines``, observed in the same scan: where line numbers and looks disagree.

    Counts the non-blank lines behind the preamble that don't look like data,
    and those of the preamble that do, or that have the layout's comma count
    and a FIPS code.
    """
    value, behind = F.col("value"), F.col("line") > preamble
    looks = is_data_line_1980(value)
    commas = F.length(value) - F.length(F.translate(value, ",", ""))
    laid_out = (commas == len(codes.WIDE_AGE_LAYOUT_COLUMNS) - 1) & value.rlike(r"^[^,]*," + _FIPS)
    return lines.observe(
        seen,
        F.count_if(behind & (F.length(F.trim(value)) > 0) & ~looks).alias(REJECTED),
        F.count_if(~behind & (looks | laid_out)).alias(ROW_LIKE),
    )


def parse_whitespace_lines(lines: DataFrame, problems: Problems | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """S3 on lines: runs of blanks separate fields; blank lines are skipped; columns ``keep`` stay beside the fields."""
    names = codes.LONG_CODE_LAYOUT_COLUMNS
    parts = F.split(F.trim(F.col("value")), r"\s+")
    body = data_lines(lines, F.length(F.trim(F.col("value"))) > 0)
    # get() gives NULL past the end, so a short line has missing tail fields
    # (under ANSI, [] would fail the whole job on one ragged line)
    rec = body.select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)], *keep, *([FILE] if problems else []))
    if problems:
        ints = [n for n in names if n != "fips"]
        rec = problems.observe(rec, ints, F.col, codes.NA_TOKENS_DEFAULT)
    return type_long_codes(rec, keep=keep)


def parse_header_csv_lines(
    lines: DataFrame, columns: Sequence[str], tokens=codes.NA_TOKENS_DEFAULT
) -> DataFrame:
    """S4–S6 on lines: fields named by ``columns`` (the header); header lines dropped."""
    body = data_lines(lines, F.col("value") != F.lit(",".join(columns)))
    ints = ("YEAR", "AGEGRP") + codes.WIDE_RACE_COLUMNS
    rec = body.select(_from_csv(F.col("value"), columns, ints).alias("r")).select("r.*")
    return type_wide_race(rec, tokens)


# ------------------------------------------------------------- file readers
def _csv(spark: SparkSession, paths, schema: T.StructType, header: bool, **opts) -> DataFrame:
    reader = spark.read.schema(schema).option("header", str(header).lower())
    reader = reader.option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true")
    reader = reader.option("columnNameOfCorruptRecord", RECORD)
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def _observed_csv(raw: DataFrame, names: Sequence[str], ints: Sequence[str], tokens: Sequence[str], problems: Problems) -> DataFrame:
    """A CSV scan with its parse problems observed: the parser hands over the text of a record that it can't type."""
    again = _texts(names, F.col(RECORD), F.col(RECORD).isNotNull())
    named = raw.select("*", F.col("_metadata.file_name").alias(FILE)).withColumn(RECORD, again)
    return problems.observe(named, ints, lambda c: F.col(f"{RECORD}.`{c}`"), tokens)


def read_wide_age_1970(spark: SparkSession, paths, problems: Problems | None = None) -> DataFrame:
    """Header-less CSV, first line is data."""
    names = codes.WIDE_AGE_LAYOUT_COLUMNS
    ints = ("year", "race_sex") + codes.WIDE_AGE_COLUMNS
    raw = _csv(spark, paths, declared_schema(names, ints, bool(problems)), header=False)
    if problems:
        raw = _observed_csv(raw, names, ints, codes.NA_TOKENS_DEFAULT, problems)
    return type_wide_age(raw, race_sex_is_text=False)


def read_wide_age_1980(
    spark: SparkSession, paths, seen: Observation | None = None, preamble: int = codes.PREAMBLE_LINES_1980, problems: Problems | None = None
) -> DataFrame:
    """CSV after ``preamble`` lines of prose, blank rows skipped, text race_sex.

    ``seen`` gets what ``observe_rejected`` counts once the result is computed.
    """
    lines = numbered_lines(spark, paths, preamble)
    return parse_preamble_lines(observe_rejected(lines, seen, preamble) if seen else lines, preamble, problems)


def read_long_codes_1990(spark: SparkSession, paths, problems: Problems | None = None) -> DataFrame:
    """S3: whitespace-separated text, many files in one scan."""
    lines = spark.read.text(paths)
    if problems:
        lines = lines.select("value", F.col("_metadata.file_name").alias(FILE))
    return parse_whitespace_lines(lines, problems)


def read_long_codes_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many files of the 1990 layout in a single scan, each row with the ``source_file`` that it comes from."""
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("source_file"))
    return parse_whitespace_lines(lines, keep=["source_file"])


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from one file's header line (no type inference)."""
    return spark.read.option("header", "true").csv(path).columns


def read_wide_race(spark: SparkSession, paths, decade: int, problems: Problems | None = None) -> DataFrame:
    """S4 (2000, 51 files), S5 (2010, 'X' missing), S6 (2020, 80 columns).

    The column names are the first file's header; the used integer columns
    are declared INT (so the CSV parser types them and can evaluate the
    YEAR/AGEGRP filter itself), everything else is text.
    ``enforceSchema=False`` makes any file whose header differs fail instead
    of being mis-assigned.  With ``problems``, filters stay above the scan, so
    that the fields of rows they drop are counted as well.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    tokens = codes.NA_TOKENS_2010 if decade == 2010 else codes.NA_TOKENS_DEFAULT
    names = header_of(spark, paths[0])
    missing = [c for c in ("YEAR", "AGEGRP", "STATE", "COUNTY") + codes.WIDE_RACE_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{paths[0]}: header lacks required columns {missing}")
    ints = ("YEAR", "AGEGRP") + codes.WIDE_RACE_COLUMNS
    raw = _csv(spark, paths, declared_schema(names, ints, bool(problems)), header=True, enforceSchema="false")
    if problems:
        raw = _observed_csv(raw, names, ints, tokens, problems)
    return type_wide_race(raw, tokens)


STATE_NAMES_SCHEMA = "state_fips STRING, state_name STRING"


def read_state_names(spark: SparkSession, path: str) -> DataFrame:
    """The state-name lookup written by ``sinks.write_state_names``."""
    return spark.read.schema(STATE_NAMES_SCHEMA).option("header", "true").csv(path)


OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("state_fips", T.StringType()),
        T.StructField("state_name", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("race_p_ethnicity", T.StringType()),
        T.StructField("population", T.LongType()),
    ]
)
assert tuple(f.name for f in OUTPUT_SCHEMA.fields) == CANONICAL


def read_decade_result(spark: SparkSession, path) -> DataFrame:
    """Re-scan a written decade (gzip CSV, header, 'NA' = missing)."""
    return (
        spark.read.schema(OUTPUT_SCHEMA)
        .option("header", "true")
        .option("nullValue", "NA")
        .csv(path)
    )
