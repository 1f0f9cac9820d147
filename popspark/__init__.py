"""popspark — population-estimate files to one long table, as Spark jobs.

Layout:
  functions/  column expressions: fixed code tables, recodes, strict sums
  operators/  DataFrame -> DataFrame building blocks (reshape, aggregate,
              join, set operations, data-quality guards)
  sources/    readers for the six source layouts, line parsers, sinks and
              census-shaped views over the driver's TPC-H-style tables
  plans/      the decade pipelines, the whole job, and the query catalogue
"""

CANONICAL = (
    "year",
    "state_fips",
    "state_name",
    "age",
    "sex",
    "race_p_ethnicity",
    "population",
)
