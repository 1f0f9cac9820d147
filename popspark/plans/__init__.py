"""Composed work.

pipelines  one function per layout family: decade → canonical long table (PL1–PL8)
job        the whole run on source files, resumable per decade (PL9)
catalog    the registered queries over the driver tables
oracle     DuckDB SQL computing the same result as each registered query
"""
