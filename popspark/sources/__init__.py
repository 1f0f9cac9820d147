"""Inputs and outputs.

readers       the six source layouts (files) and their line parsers (S1–S9)
sinks         gzip CSV, state-name CSV, Parquet by decade (S10–S12)
driver_views  census-shaped layouts derived by Spark from the driver's tables
"""
