"""Files of all six layouts rendered from the driver tables, run through the
whole job, must equal the in-memory pipelines on the same tables."""

import os

from materialize_sources import materialize

from popspark.functions import codes
from popspark.plans import catalog, job
from popspark.sources import driver_views as dv

from conftest import SF001


def test_job_on_files_equals_in_memory_pipelines(spark, tmp_path):
    src = materialize(spark, SF001, str(tmp_path / "src"))
    assert sum(len(os.listdir(os.path.join(src, str(d)))) for d in codes.DECADES) == 65
    combined = job.run_job(spark, src, str(tmp_path / "out"), dv.county_fips_table(spark, SF001))
    in_memory = catalog.QUERIES["union_decades"](spark, SF001)
    assert combined.count() == in_memory.count() > 0
    assert combined.exceptAll(in_memory).count() == 0
    assert in_memory.exceptAll(combined).count() == 0
