"""Layout readers (S1–S9) and decade pipelines on invented files (FIXTURES.md)."""

import contextlib
import os

import pytest

from popspark.functions import codes
from popspark.plans import job
from popspark.plans import pipelines as pl
from popspark.sources import readers, sinks

import fixtures as fx
from conftest import rows, write


@pytest.fixture(scope="module")
def src(tmp_path_factory):
    return fx.build_source_tree(str(tmp_path_factory.mktemp("src")))


@pytest.fixture(scope="module")
def names(spark):
    county = spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")
    return pl.state_names(county)


def _paths(src, decade):
    return job.source_paths(src, decade)


def test_state_names_dimension(spark, names):
    assert rows(names) == [("01", "Alabama"), ("02", "Alaska"), ("56", "Wyoming")]  # 60 filtered as a string


def test_read_1970_typed_with_na(spark, src):
    df = readers.read_wide_age_1970(spark, _paths(src, 1970))
    assert [f.dataType.simpleString() for f in df.schema.fields[:3]] == ["int", "string", "int"]
    got = {(r.fips, r.race_sex): r.age0_4 for r in df.collect()}
    assert got[("01001", 1)] == 1 and got[("02003", 3)] is None  # NA → NULL


def test_pipeline_1970(spark, src, names):
    out = pl.pipeline(1970, readers.read_wide_age_1970(spark, _paths(src, 1970)), names)
    got = {(r.state_fips, r.sex, r.race_p_ethnicity, r.age): (r.state_name, r.population) for r in out.collect()}
    # row 1 band sums 10, 18, 27, 36, 80
    assert [got[("01", "Male", "White", b)][1] for b in codes.BANDS] == [10, 18, 27, 36, 80]
    assert got[("01", "Male", "White", "0-19")][0] == "Alabama"
    # unmapped race_sex: row kept with NULL sex and race
    assert got[("02", None, None, "65+")] == ("Alaska", 5)
    # NA in one 0-19 column nulls that band only, and the national cell
    assert [got[("02", "Male", "Black", b)][1] for b in codes.BANDS] == [None, 3, 3, 3, 5]
    assert got[("00", "Male", "Black", "0-19")] == ("United States", None)
    assert got[("00", "Female", "White", "65+")] == ("United States", 5)
    assert len(out.columns) == 7 and out.columns[-1] == "population"


def test_read_1980_preamble_and_padding(spark, src, names):
    raw = readers.read_wide_age_1980(spark, _paths(src, 1980))
    assert raw.count() == 2  # 14 preamble lines and the blank line skipped
    out = pl.pipeline(1980, raw, names)
    got = {(r.state_fips, r.sex, r.race_p_ethnicity, r.age): r.population for r in out.collect()}
    assert got[("01", "Male", "White", "0-19")] == 10  # '1001' → '01001' → state 01
    assert got[("10", "Female", "Other", "65+")] == 5
    names_of = {r.state_fips: r.state_name for r in out.collect()}
    assert names_of["10"] is None and names_of["01"] == "Alabama"  # unmatched state keeps a NULL name
    assert got[("00", "Female", "Other", "65+")] == 5


def test_read_1990_whitespace_ten_files(spark, src):
    df = readers.read_long_codes_1990(spark, _paths(src, 1990))
    assert df.count() == len(fx.ROWS_1990) + 9  # one scan over ten files (U2)
    r = {(x.fips, x.age, x.race_sex): x.population for x in df.collect()}
    assert r[("101", 18, 8)] == 5 and r[("1001", 1, 1)] == 12


def test_pipeline_1990_hispanic_total(spark, src, names):
    raw = readers.read_long_codes_1990(spark, _paths(src, 1990)[:1])
    out = pl.pipeline(1990, raw, names)
    got = {(r.state_fips, r.age, r.sex, r.race_p_ethnicity): r.population for r in out.collect()}
    # '101' pads to '0101' → state 01; NH_API for (01, 65+, Female)
    assert got[("01", "65+", "Female", "NH_API")] == 5
    # all four Hispanic cells present for (02, 65+, Female) → H = 3+4+6+7
    assert got[("02", "65+", "Female", "H")] == 20
    # (01, 0-19, Male) has only Hispanic_White → H NULL; national H NULL too
    assert got[("01", "0-19", "Male", "H")] is None
    assert got[("00", "0-19", "Male", "H")] is None
    # pivot densifies: NH_White exists for (02, 65+, Female) as a NULL cell
    assert ("02", "65+", "Female", "NH_White") in got and got[("02", "65+", "Female", "NH_White")] is None
    assert got[("01", "0-19", "Male", "NH_White")] == 239
    races = {k[3] for k in got}
    assert races == {"NH_White", "NH_API", "H"}  # only cells present in the data, plus H


def test_pipeline_2000(spark, src, names):
    raw = readers.read_wide_race(spark, _paths(src, 2000), 2000)
    assert raw.count() == 57  # 7 rows in the first file, one in each of the other 50
    out = pl.pipeline(2000, raw, names)
    got = {(r.year, r.state_fips, r.age, r.sex, r.race_p_ethnicity): r.population for r in out.collect()}
    assert {k[0] for k in got} == {2000, 2009}  # YEAR 2 and 11 only
    assert got[(2000, "01", "0-19", "Male", "NH_White")] == 1  # AGEGRP 0 kept
    assert got[(2000, "01", "20-34", "Female", "Hispanic")] == 5  # two counties summed
    assert got[(2009, "56", "65+", "Male", "NH_TOM")] == 4
    assert got[(2000, "00", "20-34", "Male", "NH_Asian")] == 5
    assert all(v < 1000 for v in got.values())  # the total row never leaks


def test_pipeline_2010_x_token(spark, src, names):
    raw = readers.read_wide_race(spark, _paths(src, 2010), 2010)
    out = pl.pipeline(2010, raw, names)
    got = {(r.year, r.state_fips, r.age, r.sex, r.race_p_ethnicity): r.population for r in out.collect()}
    assert {k[0] for k in got} == {2010, 2019}
    assert got[(2010, "01", "0-19", "Male", "Hispanic")] is None  # 'X'
    assert got[(2010, "00", "0-19", "Male", "Hispanic")] is None  # nulls the nation
    assert got[(2010, "00", "0-19", "Female", "Hispanic")] == 11
    assert got[(2019, "02", "65+", "Female", "NH_White")] == 7
    assert all(v is None or v < 1000 for v in got.values())  # the AGEGRP 0 total row never leaks


def test_pipeline_2020(spark, src, names):
    raw = readers.read_wide_race(spark, _paths(src, 2020), 2020)
    assert len(readers.header_of(spark, _paths(src, 2020)[0])) == 80
    out = pl.pipeline(2020, raw, names)
    got = {(r.year, r.state_fips, r.age, r.sex, r.race_p_ethnicity): r.population for r in out.collect()}
    assert {k[0] for k in got} == {2020, 2024}
    assert got[(2020, "01", "0-19", "Female", "NH_NHPI")] == 8
    assert got[(2024, "00", "65+", "Male", "NH_AIAN")] == 9
    assert all(v is None or v < 1000 for v in got.values())  # the AGEGRP 0 total row never leaks


def test_header_drift_fails(spark, tmp_path):
    good = write(str(tmp_path / "a.csv"), ",".join(fx.H2000) + "\n" + fx.rows_2000(fx.H2000)[1] + "\n")
    swapped = list(fx.H2000)
    swapped[2], swapped[3] = swapped[3], swapped[2]  # YEAR and AGEGRP swapped
    bad = write(str(tmp_path / "b.csv"), ",".join(swapped) + "\n" + fx.rows_2000(fx.H2000)[1] + "\n")
    with pytest.raises(Exception):
        readers.read_wide_race(spark, [good, bad], 2000).collect()


def test_write_and_rescan_roundtrip(spark, src, names, tmp_path):
    out = pl.pipeline(1970, readers.read_wide_age_1970(spark, _paths(src, 1970)), names)
    path = str(tmp_path / "d1970")
    sinks.write_csv_gz(out, path)
    assert any(f.endswith(".csv.gz") for f in os.listdir(path))
    back = readers.read_decade_result(spark, path)
    assert back.schema == readers.OUTPUT_SCHEMA
    assert rows(back) == rows(out)  # NA ↔ NULL round-trips


def test_whole_job(spark, src, tmp_path):
    county = spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")
    out_root = str(tmp_path / "out")
    combined = job.run_job(spark, src, out_root, county)
    years = {r.year for r in combined.select("year").distinct().collect()}
    assert {1970, 1980, 1990, 2000, 2010, 2020} <= years
    n = combined.count()
    parquet = job.read_product_copy(spark, out_root)
    assert parquet.count() == n
    assert sorted(r.decade for r in parquet.select("decade").distinct().collect()) == list(codes.DECADES)
    # resumable: a second run reuses every written decade
    again = job.run_job(spark, src, out_root, county, resume=True)
    assert again.count() == n


def test_whole_job_missing_source_fails(spark, src, tmp_path):
    county = spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")
    partial = fx.build_source_tree(str(tmp_path / "partial"))
    os.remove(os.path.join(partial, "2000", codes.source_manifest()[2000][7]))
    with pytest.raises(Exception, match="missing source files"):
        job.run_job(spark, partial, str(tmp_path / "out2"), county)


def test_job_writes_decades_in_export_order(spark, src, tmp_path):
    import glob

    import pandas as pd

    county = spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")
    out_root = str(tmp_path / "ordered")
    job.run_job(spark, src, out_root, county, decades=(1990, 2000))
    for decade in (1990, 2000):
        parts = sorted(glob.glob(os.path.join(job.decade_output(spark, out_root, decade), "part-*.csv.gz")))
        frame = pd.concat([pd.read_csv(p, dtype=str, keep_default_na=False) for p in parts])
        is_us = (frame.state_fips == "00").tolist()
        assert is_us == sorted(is_us)  # every state row before every national row
        states = frame[frame.state_fips != "00"]
        keys = list(zip(states.year.astype(int), states.state_fips))
        assert keys == sorted(keys)


def test_parquet_copy_prunes_decades(spark, src, tmp_path):
    county = spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")
    out_root = str(tmp_path / "pq")
    job.run_job(spark, src, out_root, county, decades=(1970, 2010))
    from pyspark.sql import functions as F

    one = job.read_product_copy(spark, out_root).filter(F.col("decade") == 2010)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert {r.year // 10 * 10 for r in one.select("year").distinct().collect()} == {2010}


def test_job_domain_report(spark, src, tmp_path):
    county = spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")
    out_root = str(tmp_path / "dr")
    job.run_job(spark, src, out_root, county, decades=(1970, 1990, 2000), domain_report=True)
    r70 = {(r.column, r.value): int(r.n_rows) for r in spark.read.option("header", "true").csv(job.output(spark, out_root, "1970/domain-violations")).collect()}
    assert r70 == {("race_sex", "9"): 1}  # the unmapped race-sex code of the fixture
    r00 = {(r.column, r.value) for r in spark.read.option("header", "true").csv(job.output(spark, out_root, "2000/domain-violations")).collect()}
    assert r00 == set()  # codes 0..18 and the total 99 are all in domain


def test_combine_reads_single_file_decade_results(spark, tmp_path):
    """Decade results in the single gzip CSV layout (NA for missing) combine as well."""
    import gzip

    out = tmp_path / "legacy"
    rows = {
        1970: "1970,01,Alabama,0-19,Male,White,10\n1970,00,United States,0-19,Male,White,NA\n",
        1990: "1990,02,Alaska,65+,Female,H,20\n",
    }
    for d, body in rows.items():
        (out / str(d)).mkdir(parents=True)
        with gzip.open(out / str(d) / f"states-asrpe{d}.csv.gz", "wt") as f:
            f.write("year,state_fips,state_name,age,sex,race_p_ethnicity,population\n" + body)
    combined = job.combine_outputs(spark, str(out), decades=(1970, 1990))
    got = sorted((r.year, r.state_fips, r.population) for r in combined.collect())
    assert got == [(1970, "00", None), (1970, "01", 10), (1990, "02", 20)]


def test_missing_required_column_is_named(spark, tmp_path):
    header = [h for h in fx.H2000 if h != "H_FEMALE"]
    bad = write(str(tmp_path / "c.csv"), ",".join(header) + "\n" + ",".join("1" for _ in header) + "\n")
    with pytest.raises(ValueError, match="H_FEMALE"):
        readers.read_wide_race(spark, [bad], 2000)


def test_1970_blank_lines_are_skipped(spark, tmp_path):
    path = write(str(tmp_path / "b.csv"), fx.ROWS_1970[0] + "\n\n   \n" + fx.ROWS_1970[1] + "\n")
    df = readers.read_wide_age_1970(spark, [path])
    assert rows(df, "fips") == [("01001",), ("01003",)]


def test_1990_short_line_gives_missing_fields(spark):
    lines = spark.createDataFrame([("90 01001  0 1 1    239",), ("90 01001 0 1",)], "value string")
    got = rows(readers.parse_whitespace_lines(lines))
    assert got == [(90, "01001", 0, 1, None, None), (90, "01001", 0, 1, 1, 239)]


def test_1970_line_parser_skips_blank_lines_like_the_file_reader(spark):
    lines = spark.createDataFrame([(fx.ROWS_1970[0],), ("",), ("   ",), (fx.ROWS_1970[1],)], "value string")
    assert rows(readers.parse_wide_age_lines(lines), "fips") == [("01001",), ("01003",)]


# ------------------------------------------------- 1980: what is a data line
def _lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_1980_short_and_quoted_rows_are_kept_and_titles_dropped(spark):
    title = ",".join(codes.WIDE_AGE_LAYOUT_COLUMNS)
    quoted = '"1980","1001","White male",' + ",".join(["1"] * 18)
    got = rows(readers.parse_preamble_lines(_lines(spark, title, "prose, " * 21, "", "1980,1001,White female,5", quoted, "  ")), "year", "fips", "race_sex", "age0_4", "age85")
    assert got == [(1980, "1001", "White female", 5, None), (1980, "1001", "White male", 1, 1)]


def test_1980_more_rejected_lines_than_the_preamble_fail(spark, src, tmp_path):
    county = spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")
    root = fx.build_source_tree(str(tmp_path / "s"))
    path = os.path.join(root, "1980", codes.source_manifest()[1980][0])
    body = open(path).read()
    job.run_job(spark, root, str(tmp_path / "ok"), county, decades=(1980,))
    write(path, body + "198O,1001,White male" + ",1" * 18 + "\n")  # a letter O in the year
    with pytest.raises(Exception, match="1 lines behind the preamble are not data lines"):
        job.run_job(spark, root, str(tmp_path / "bad"), county, decades=(1980,))


@pytest.mark.parametrize("year", ["", "NA", '""'])
def test_1980_rows_without_a_year_are_kept(spark, year):
    got = rows(readers.parse_preamble_lines(_lines(spark, "By age, 1980, of all", f"{year},1001,White male" + ",1" * 18, f"{year}, 10003,White male,7")), "year", "fips", "age0_4", "age85")
    assert got == [(None, "10003", 7, None), (None, "1001", 1, 1)]


@pytest.mark.parametrize(
    ("first", "last", "error"),
    [
        (["198O,1001,White male" + ",1" * 18], [], "1 of the 14 lines of the preamble are laid out as rows"),
        ([fx.ROWS_1980[0]], [], "1 of the 14 lines of the preamble are laid out as rows"),
        ([], ["198O,1001,White male"], "1 lines behind the preamble are not data lines"),
        (["By age, 1980, of all"], [",1001,White male" + ",1" * 18], None),
    ],
)
def test_1980_lines_that_disagree_with_their_numbers_fail(spark, tmp_path, first, last, error):
    """A preamble of 14 lines, blank ones among them, as in the layout."""
    root = fx.build_source_tree(str(tmp_path / "s"))
    preamble = [*fx.PREAMBLE_1980[: 13 - len(first)], "", *first]
    write(os.path.join(root, "1980", codes.source_manifest()[1980][0]), "\n".join([*preamble, *fx.ROWS_1980, *last]) + "\n")
    if error:
        with pytest.raises(Exception, match=error):
            job.run_job(spark, root, str(tmp_path / "o"), _county(spark), decades=(1980,))
    else:
        got = job.run_job(spark, root, str(tmp_path / "o"), _county(spark), decades=(1980,)).collect()
        assert sum(r.population or 0 for r in got if r.year is None and r.state_fips == "01") == 18


@pytest.mark.parametrize("split_bytes", [16, 200, 1 << 20])
def test_line_numbers_hold_across_splits_and_files(spark, tmp_path, split_bytes):
    """Splits of a few bytes: many hold no line start, a few lines, or a part of the preamble."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    texts = {
        "a.txt": "".join(f"{'x' * (i * 7 % 40)}{i}\n" for i in range(1, 301)),
        "b.txt": "\n\n" + "".join(f"row {i}\n" for i in range(3, 60)),  # blank lines count
        "c.txt": "only one line, no end",
        "d.txt": "",
    }
    paths = [write(str(tmp_path / n), t) for n, t in texts.items()]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        if split_bytes < 300:
            assert spark.read.text(paths).rdd.getNumPartitions() > 4
        for first in (1, 14, 40):
            got = sorted((r.value, r.line) for r in readers.numbered_lines(spark, paths, first).collect())
            lines = [(x, i + 1) for t in texts.values() for i, x in enumerate(t.splitlines())]
            # behind ``first`` only the fact is exact
            cut = lambda found: sorted((x, min(n, first + 1)) for x, n in found)
            assert cut(got) == cut(lines)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_1980_positions_decide_whatever_the_lines_hold(spark, tmp_path):
    """Line 14 looks like data and is skipped; line 15 doesn't, and is a row."""
    row = "1980,1001,White male" + ",1" * 18
    path = write(str(tmp_path / "p.csv"), "\n".join([*fx.PREAMBLE_1980[:13], row, "n/a,1003,Black male,5", "", row]) + "\n")
    got = rows(readers.read_wide_age_1980(spark, [path]), "year", "fips", "age0_4", "age85")
    assert got == [(None, "1003", 5, None), (1980, "1001", 1, 1)]


# -------------------------------------------------------- audit, D3, resume
def _county(spark):
    return spark.createDataFrame(fx.COUNTY_TABLE, "state_code string, state_name string, county_code string")


def test_empty_and_header_only_files_fail_and_all_are_named(spark, tmp_path):
    root = fx.build_source_tree(str(tmp_path / "s"))
    m = codes.source_manifest()
    write(os.path.join(root, "2000", m[2000][3]), ",".join(fx.H2000) + "\n\n")
    write(os.path.join(root, "1970", m[1970][0]), "")
    write(os.path.join(root, "1980", m[1980][0]), "\n".join(fx.PREAMBLE_1980) + "\n")
    os.remove(os.path.join(root, "2020", m[2020][0]))
    with pytest.raises(Exception) as e:
        job.run_job(spark, root, str(tmp_path / "o"), _county(spark))
    for d, f in ((2000, m[2000][3]), (1970, m[1970][0]), (1980, m[1980][0]), (2020, m[2020][0])):
        assert f"{d}/{f}" in str(e.value)
    assert "(4)" in str(e.value)
    with pytest.raises(Exception) as e:
        job.run_job(spark, str(tmp_path / "none"), str(tmp_path / "o"), _county(spark))
    assert "(65)" in str(e.value) and all(f in str(e.value) for fs in m.values() for f in fs)


def _tree(root):
    """Content of every published file, by folder; part names change, so they don't count."""
    found = {}
    for base, _, names in os.walk(root):
        if "_staging" not in base:
            data = [open(os.path.join(base, n), "rb").read() for n in names if not n.endswith(".crc")]
            found[os.path.relpath(base, root)] = sorted(data)
    return found


def test_a_failed_run_leaves_the_published_outputs(spark, tmp_path):
    root, out = fx.build_source_tree(str(tmp_path / "s")), str(tmp_path / "o")
    job.run_job(spark, root, out, _county(spark))
    before = _tree(out)
    path = os.path.join(root, "1970", codes.source_manifest()[1970][0])
    write(path, open(path).read().replace(",18\n", ",5018\n"))
    bad = os.path.join(root, "2000", codes.source_manifest()[2000][5])
    good = open(bad).read()
    write(bad, good.replace("NHWA_MALE", "NHWA_MALES"))
    with pytest.raises(Exception, match="failed to process 2000"):
        job.run_job(spark, root, out, _county(spark))
    assert _tree(out) == before
    write(bad, good)
    again = job.run_job(spark, root, out, _county(spark), resume=True)
    assert again.agg({"population": "max"}).first()[0] >= 5000  # the new 1970 row is in the product
    assert not os.path.exists(os.path.join(out, "_staging"))
    assert not [n for n in os.listdir(out) if n.startswith("_replaced")]


def test_resume_after_one_decade_gives_all_six(spark, tmp_path):
    root, out = fx.build_source_tree(str(tmp_path / "s")), str(tmp_path / "o")
    job.run_job(spark, root, out, _county(spark), decades=(2010,))
    combined = job.run_job(spark, root, out, _county(spark), resume=True)
    assert {1970, 1980, 1990, 2000, 2010, 2020} <= {r.year for r in combined.select("year").distinct().collect()}
    copy = job.read_product_copy(spark, out)
    assert {r.decade for r in copy.select("decade").distinct().collect()} == set(codes.DECADES)
    assert copy.count() == combined.count()


def test_resume_reuses_complete_decades_and_redoes_changed_ones(spark, tmp_path, monkeypatch):
    root, out = fx.build_source_tree(str(tmp_path / "s")), str(tmp_path / "o")
    made, real = [], job.write_decade

    def counted(spark, src, path, decade, names):
        made.append(decade)
        if decade == fail_at:
            raise RuntimeError("stop")
        return real(spark, src, path, decade, names)

    monkeypatch.setattr(job, "write_decade", counted)
    fail_at = 2000
    with pytest.raises(Exception, match="stop"):
        job.run_job(spark, root, out, _county(spark))
    fail_at, made[:] = 2010, []
    path = os.path.join(root, "1980", codes.source_manifest()[1980][0])
    write(path, open(path).read() + "1980,1001,White male,9\n")
    with pytest.raises(Exception, match="stop"):
        job.run_job(spark, root, out, _county(spark), resume=True)
    assert made == [1980, 2000, 2010]
    fail_at, made[:] = None, []
    other = spark.createDataFrame([("01", "Alabama renamed", "001")], "state_code string, state_name string, county_code string")
    combined = job.run_job(spark, root, out, other, resume=True)
    assert made == list(codes.DECADES)  # the lookup changed, so every decade is redone
    assert "Alabama renamed" in {r.state_name for r in combined.select("state_name").distinct().collect()}


def test_product_is_ordered_and_parquet_carries_the_source_decade(spark, src, tmp_path):
    out = str(tmp_path / "o")
    combined = job.run_job(spark, src, out, _county(spark))
    got = [tuple(r) for r in combined.collect()]
    want = []
    for d in codes.DECADES:
        want += [tuple(r) for r in readers.read_decade_result(spark, job.decade_output(spark, out, d)).collect()]
    assert got == want
    copy = job.read_product_copy(spark, out)
    for d in codes.DECADES:
        one = copy.filter(f"decade = {d}").drop("decade")
        assert sorted(map(str, one.collect())) == sorted(map(str, readers.read_decade_result(spark, job.decade_output(spark, out, d)).collect()))


def test_missing_years_stay_in_their_decade(spark, tmp_path):
    df = spark.createDataFrame([(None, "01", "A", "0-19", "Male", "White", 1), (2012, "01", "A", "0-19", "Male", "White", 2)], readers.OUTPUT_SCHEMA)
    sinks.write_parquet_by_decade(pl.combine({2010: df}), str(tmp_path / "p"))
    assert [r.decade for r in spark.read.parquet(str(tmp_path / "p")).collect()] == [2010, 2010]


def test_gzip_round_trip_with_comma_quote_and_missing(spark, tmp_path):
    df = spark.createDataFrame([(1970, "01", 'A, "B" C', "0-19", None, "White", 5), (1970, "02", "D", "65+", "Male", None, None)], readers.OUTPUT_SCHEMA)
    sinks.write_csv_gz(df, str(tmp_path / "g"))
    assert sorted(map(str, readers.read_decade_result(spark, str(tmp_path / "g")).collect())) == sorted(map(str, df.collect()))
    sinks.write_state_names(df.select("state_fips", "state_name"), str(tmp_path / "n"))
    assert {r.state_name for r in readers.read_state_names(spark, str(tmp_path / "n")).collect()} == {'A, "B" C', "D"}


def test_positions_number_the_whole_product(spark, src):
    """1 to n, in the order of the decades and of each decade's export."""
    from popspark.operators import setops

    names = spark.createDataFrame([("01", "Alabama"), ("02", "Alaska")], "state_fips string, state_name string")
    parts = {d: pl.pipeline(d, job.read_decade(spark, d, job.source_paths(src, d)), names) for d in codes.DECADES}
    got = setops.product_positions(parts).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, len(got) + 1))
    want = []
    for d, df in parts.items():
        want += [(*r, d) for r in setops.export_order(setops.canonical(df), d).collect()]
    assert [tuple(r)[:8] for r in got] == want


# ------------------------------------------------------------ commits (D3)
class Killed(BaseException):
    """Not an Exception, as a killed driver runs no handler either."""


def _steps(monkeypatch, stop_after=None):
    """Counts the file-system changes of publish, and ends it after some of them."""
    done = []

    def counted(real):
        def run(*args, **kw):
            if stop_after is not None and len(done) >= stop_after:
                raise Killed
            out = real(*args, **kw)
            done.append(real.__name__)
            return out

        return run

    for step in ("rename", "remove"):
        monkeypatch.setattr(sinks, step, counted(getattr(sinks, step)))
    return done


def _published(spark, root, names):
    return {open(os.path.join(sinks.output(spark, root, n), "x")).read() for n in names}


def test_publish_is_one_step(spark, tmp_path, monkeypatch):
    """Ended after every single step, the outputs are all old or all new."""
    names, states = ["a", "b/c", "d"], []
    for stop in range(12):
        root = str(tmp_path / str(stop))
        with monkeypatch.context() as m:
            for content in ("first", "old"):
                for n in names:
                    write(f"{root}/_staging/{n}/x", content)
                sinks.publish(spark, f"{root}/_staging", root, names)
            for n in names:
                write(f"{root}/_staging/{n}/x", "new")
            done = _steps(m, stop)
            try:
                sinks.publish(spark, f"{root}/_staging", root, names)
                ended = True
            except Killed:
                ended = False
        found = _published(spark, root, names)
        assert len(found) == 1
        states.append(found.pop())
        # whatever was left behind, the next run publishes and clears it
        sinks.reclaim(spark, f"{root}/_staging", root)
        for n in names:
            write(f"{root}/_staging/{n}/x", "next")
        sinks.publish(spark, f"{root}/_staging", root, names)
        assert _published(spark, root, names) == {"next"}
        assert len(os.listdir(f"{root}/_versions")) <= 2 and not os.path.exists(f"{root}/_staging")
        if ended:
            break
    assert ended and states == sorted(states, reverse=True) and {"old", "new"} == set(states)
    assert states.count("old") == 2  # the move of the folder, and the one rename that commits


def test_publish_of_some_outputs_keeps_the_others(spark, tmp_path):
    root = str(tmp_path / "o")
    for k, names in enumerate((["a", "b"], ["b"], ["c"])):
        for n in names:
            write(f"{root}/_staging/{n}/x", f"{n}{k}")
        sinks.publish(spark, f"{root}/_staging", root, names, {"b": str(k)} if k == 0 else None, gone=["a"] if k == 2 else [])
    found = sinks.newest(spark, root)
    assert found.number == 3 and set(found.outputs) == {"b", "c"}
    assert _published(spark, root, ["b", "c"]) == {"b1", "c2"}
    assert found.inputs == {}  # b was made anew, from something else
    with pytest.raises(OSError, match="gone"):
        sinks.publish(spark, f"{root}/_staging", root, ["gone"])
    assert sinks.newest(spark, root).number == 3


def test_a_reader_of_the_commit_before_still_finds_its_files(spark, tmp_path):
    root = str(tmp_path / "o")
    write(f"{root}/_staging/a/x", "old")
    sinks.publish(spark, f"{root}/_staging", root, ["a"])
    held = sinks.output(spark, root, "a")
    write(f"{root}/_staging/a/x", "new")
    sinks.publish(spark, f"{root}/_staging", root, ["a"])
    assert open(f"{held}/x").read() == "old" and _published(spark, root, ["a"]) == {"new"}


@pytest.mark.parametrize("stop_after", [0, 1, 2])
def test_a_killed_job_leaves_one_consistent_product(spark, tmp_path, monkeypatch, stop_after):
    """Killed before, between and after the two moves of its last phase; CSV and copy always agree."""
    root, out = fx.build_source_tree(str(tmp_path / "s")), str(tmp_path / "o")
    decades = (1970, 2010)
    job.run_job(spark, root, out, _county(spark), decades)
    path = os.path.join(root, "1970", codes.source_manifest()[1970][0])
    write(path, open(path).read().replace(",18\n", ",5018\n"))
    real = sinks.publish

    def ended(*args, **kw):
        _steps(monkeypatch, stop_after)
        return real(*args, **kw)

    with monkeypatch.context() as m:
        m.setattr(sinks, "publish", ended)
        with contextlib.suppress(Killed):
            job.run_job(spark, root, out, _county(spark), decades)
    monkeypatch.undo()
    most = {job.read_product(spark, out).agg({"population": "max"}).first()[0], job.read_product_copy(spark, out).agg({"population": "max"}).first()[0]}
    assert len(most) == 1 and (most.pop() >= 5000) == (stop_after == 2)
    again = job.run_job(spark, root, out, _county(spark), decades, resume=True)
    assert again.agg({"population": "max"}).first()[0] >= 5000


# ------------------------------------------- content digests, partial rewrite
def _times(spark, out, name):
    base = job.output(spark, out, name)
    return {f: os.stat(os.path.join(base, f)).st_mtime_ns for f in os.listdir(base)}


def test_incremental_run_rewrites_changed_decades_only(spark, tmp_path, monkeypatch):
    root, out = fx.build_source_tree(str(tmp_path / "s")), str(tmp_path / "o")
    decades = (1970, 1980, 1990)
    job.run_job(spark, root, out, _county(spark), decades)
    made, real = [], job.write_decade
    monkeypatch.setattr(job, "write_decade", lambda spark, src, path, decade, *a: made.append(decade) or real(spark, src, path, decade, *a))
    before = {d: (_times(spark, out, job.copy_name(d)), _times(spark, out, job.decade_name(d))) for d in decades}

    # equal size and time, another content
    path = os.path.join(root, "1970", codes.source_manifest()[1970][0])
    text, at = open(path).read(), os.stat(path).st_mtime_ns
    write(path, text.replace(",18\n", ",81\n"))
    os.utime(path, ns=(at, at))
    assert os.stat(path).st_size == len(text) and text != open(path).read()
    # touched, and its rows in another order: nothing to do
    other = os.path.join(root, "1990", codes.source_manifest()[1990][0])
    lines = open(other).read().splitlines()
    write(other, "\n".join(reversed(lines)) + "\n")

    job.run_job(spark, root, out, _county(spark), decades, incremental=True)
    assert made == [1970]
    after = {d: (_times(spark, out, job.copy_name(d)), _times(spark, out, job.decade_name(d))) for d in decades}
    assert after[1980] == before[1980] and after[1990] == before[1990] and after[1970] != before[1970]
    copy = job.read_product_copy(spark, out)
    assert sorted(map(str, copy.drop("decade").collect())) == sorted(map(str, job.read_product(spark, out).collect()))
    fresh = job.run_job(spark, root, str(tmp_path / "p"), _county(spark), decades)
    assert rows(fresh) == rows(job.read_product(spark, out))
    # fewer decades: the copy has no more than the product
    job.run_job(spark, root, out, _county(spark), (1980,), incremental=True)
    assert {r.decade for r in job.read_product_copy(spark, out).select("decade").distinct().collect()} == {1980}


def test_content_digest(spark, tmp_path):
    """A multiset of lines: order and splits don't count, repeats do; numbered lines count with their number."""

    def digest(decade, *texts):
        paths = [write(str(tmp_path / f"{i}.txt"), t) for i, t in enumerate(texts)]
        return sorted(tuple(r) for r in job.content(spark, decade, paths).collect())

    long = "".join(f"line {i}\n" for i in range(500))
    base = digest(1990, "a\nb\nb\n", long)
    assert base == digest(1990, "b\na\nb\n", "".join(sorted(long.splitlines(True))))
    assert len({str(x) for x in (base, digest(1990, "a\na\nb\n", long), digest(1990, "a\nb\n", long), digest(1990, "a\nb\nc\n", long))}) == 4
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert digest(1990, "a\nb\nb\n", long) == base
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    swapped = long.splitlines(True)
    swapped[0], swapped[20] = swapped[20], swapped[0]
    assert digest(1990, long) == digest(1990, "".join(swapped))
    assert digest(1980, long) != digest(1980, "".join(swapped)) and digest(2010, long) != digest(2010, "".join(swapped))


# ------------------------------------------------------------ parse problems
def test_parse_problems_are_counted_per_file_and_column(spark, tmp_path):
    """Fields that are neither missing nor integers, in every layout, by the scan that computes the result."""
    root, out = fx.build_source_tree(str(tmp_path / "s")), str(tmp_path / "o")
    m = codes.source_manifest()

    def add(decade, k, *lines):
        path = os.path.join(root, str(decade), m[decade][k])
        write(path, open(path).read() + "".join(x + "\n" for x in lines))
        return m[decade][k]

    wide = ",1" * 16
    a = add(1970, 0, "1970,01001,1,x,1.5" + wide, "1970,01001,one,NA," + wide, "1970,01001,1, 7 ,x" + wide)
    b = add(1980, 0, "1980,1001,White male,x,NA" + wide, "1980,1001,White male,1")
    c = [add(1990, 0, "90 01001 0 1 1 12a", "90 01001 NA 1 1 5", "90 01001"), add(1990, 7, "9O 01001 0 x 1 5")]
    head = fx.H2000
    row = dict.fromkeys(head, "1") | {"STATE": "01", "COUNTY": "001", "YEAR": "3", "AGEGRP": "2"}
    line = lambda **kw: ",".join((row | kw)[h] for h in head)
    d = [add(2000, 3, line(H_MALE="?"), line(H_MALE="X"), line(AGEGRP="99", H_MALE="?")), add(2000, 50, line(YEAR="y", NHWA_MALE="NA"))]
    job.run_job(spark, root, out, _county(spark), (1970, 1980, 1990, 2000), parse_report=True)

    def report(decade):
        found = spark.read.option("header", "true").csv(job.output(spark, out, f"{decade}/parse-problems"))
        return {(r.file_name, r.column): int(r.n_fields) for r in found.collect()}

    age = codes.WIDE_AGE_COLUMNS
    assert report(1970) == {(a, age[0]): 1, (a, age[1]): 2, (a, "race_sex"): 1}
    assert report(1980) == {(b, age[0]): 1}
    assert report(1990) == {(c[0], "population"): 1, (c[1], "year"): 1, (c[1], "race_sex"): 1}
    # the row with the total age is dropped by a filter, and counted all the same
    assert report(2000) == {(d[0], "H_MALE"): 3, (d[1], "YEAR"): 1}


def test_parse_report_reads_2010_tokens_as_missing_and_changes_no_result(spark, src, tmp_path):
    plain = job.run_job(spark, src, str(tmp_path / "a"), _county(spark))
    counted = job.run_job(spark, src, str(tmp_path / "b"), _county(spark), parse_report=True)
    assert rows(counted) == rows(plain)
    for d in codes.DECADES:
        found = spark.read.option("header", "true").csv(job.output(spark, str(tmp_path / "b"), f"{d}/parse-problems"))
        assert found.count() == 0, (d, found.collect())


def test_ambiguous_state_names_are_reported(spark, src, tmp_path):
    two = spark.createDataFrame([("01", "Alabama", "001"), ("01", "Ala.", "003"), ("02", "Alaska", "001")], "state_code string, state_name string, county_code string")
    job.run_job(spark, src, str(tmp_path / "o"), two, decades=(1970,), domain_report=True)
    assert [(r.state_fips, r.n_names) for r in spark.read.option("header", "true").csv(job.output(spark, str(tmp_path / "o"), "state_names-violations")).collect()] == [("01", "2")]
