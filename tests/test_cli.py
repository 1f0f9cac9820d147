"""The command line drives the same job (state names, audit, one decade, whole run)."""

import os

import pytest

from popspark.__main__ import main
from popspark.plans import job

import fixtures as fx
from conftest import write


def test_cli_state_names_decade_and_run(spark, tmp_path, capsys):
    src = fx.build_source_tree(str(tmp_path / "src"))
    county = write(
        str(tmp_path / "fips.csv"),
        "state_code,state_name,county_code\n" + "\n".join(",".join(r) for r in fx.COUNTY_TABLE) + "\n",
    )
    out = str(tmp_path / "data")
    assert main(["state-names", "--county", county, "--out", out]) == 0
    names = spark.read.option("header", "true").csv(job.output(spark, out, "state_names"))
    assert sorted(r.state_fips for r in names.collect()) == ["01", "02", "56"]
    assert main(["audit", "--src", src]) == 0
    assert main(["decade", "--src", src, "--out", out, "--decade", "2010"]) == 0
    assert os.path.exists(os.path.join(job.decade_output(spark, out, 2010), "_SUCCESS"))
    assert main(["combine", "--out", out, "--decade", "2010"]) == 0
    assert job.read_product(spark, out).count() > 0
    assert main(["run", "--src", src, "--out", out, "--county", county]) == 0
    assert os.path.exists(os.path.join(job.output(spark, out, "states-asrpe"), "_SUCCESS"))
    capsys.readouterr()
    assert main(["where", "--out", out, "states-asrpe"]) == 0
    assert capsys.readouterr().out.strip() == job.output(spark, out, "states-asrpe")


def test_cli_audit_fails_on_missing(tmp_path):
    with pytest.raises(Exception, match="missing source files"):
        main(["audit", "--src", str(tmp_path / "nothing"), "--decade", "1970"])
