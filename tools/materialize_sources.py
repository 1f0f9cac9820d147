"""Write the 65 source files of all six layouts from the driver tables.

    python tools/materialize_sources.py <sf_dir> <out_root>

A local test tool for small tables (a whole layout goes through one task): each file is rendered by Spark (the same text views the
scan queries parse), written as one part and renamed to its expected name,
so ``plans.job.run_job`` can be run end to end on realistic volumes.
"""

from __future__ import annotations

import glob
import os
import shutil
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from popspark.functions import codes  # noqa: E402
from popspark.session import local_session  # noqa: E402
from popspark.sources import driver_views as dv  # noqa: E402


def _write_one(lines, path: str) -> None:
    """Write lines to exactly ``path``; in the order of the column ``line``, if there is one."""
    tmp = path + ".parts"
    one = lines.repartition(1)
    if "line" in lines.columns:  # sorted in the one task that writes, so the order holds
        one = one.sortWithinPartitions("line")
    one.select("value").write.mode("overwrite").text(tmp)
    part = [p for p in glob.glob(os.path.join(tmp, "part-*")) if not p.endswith(".crc")]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if part:
        shutil.move(part[0], path)
    else:  # no rows: an empty file
        open(path, "w").close()
    shutil.rmtree(tmp)


def materialize(spark, sf: str, root: str) -> str:
    m = codes.source_manifest()
    _write_one(dv.lines_1970(spark, sf).select("value"), f"{root}/1970/{m[1970][0]}")
    _write_one(dv.lines_1980(spark, sf), f"{root}/1980/{m[1980][0]}")
    # 1990: lines spread over the ten files by a hash (each line carries its own year)
    l90 = dv.lines_1990(spark, sf).select("value").withColumn("k", F.pmod(F.hash("value"), F.lit(10))).persist()
    for i, name in enumerate(m[1990]):
        _write_one(l90.filter(F.col("k") == i).select("value"), f"{root}/1990/{name}")
    l90.unpersist()
    # 2000: lines spread over the 51 files by a hash, so that every file has rows
    cols = dv.wide_race_columns(2000)
    header = ",".join(cols)
    body = dv.lines_wide_race(spark, sf, 2000).filter(~F.col("skip")).select("value")
    target = F.pmod(F.hash("value"), F.lit(len(m[2000])))
    body = body.withColumn("target", target).persist()
    head = spark.createDataFrame([(header, 0)], "value string, line int")
    for i, name in enumerate(m[2000]):
        part = body.filter(F.col("target") == i).select("value", F.lit(1).alias("line"))
        _write_one(head.unionByName(part), f"{root}/2000/{name}")
    body.unpersist()
    for d in (2010, 2020):
        lines = dv.lines_wide_race(spark, sf, d)
        _write_one(lines.withColumn("line", (~F.col("skip")).cast("int")), f"{root}/{d}/{m[d][0]}")
    return root


if __name__ == "__main__":
    spark = local_session(8)
    print(materialize(spark, sys.argv[1], sys.argv[2]))
