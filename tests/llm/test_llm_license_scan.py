import re

from popspark.llm import license_scan
from popspark.llm.common import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    ws = WORD.findall((text or "").translate(UP))
    places, base, labels, score = set(), set(), set(), 0.0
    for label, phrase in license_scan.BASE.items():
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i : i + len(p)] == p:
                places.add((i, label))
                base.add(label)
    half = license_scan.BLOCK // 2
    start = 0
    while ws:
        block = set(ws[start : start + license_scan.BLOCK])
        for label, t in license_scan.TEMPLATES:
            want = set(t.split())
            share = len(want & block) / len(want)
            if 1000 * len(want & block) >= 800 * len(want):
                labels.add(label)
                score = max(score, share)
        if start + license_scan.BLOCK >= len(ws):
            break
        start += half
    at = sorted(i for i, _ in places)
    return (len(ws), len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted(base)), ",".join(sorted(labels | base)), 1.0 if base else score)


def texts():
    filler = " ".join(f"w{i}" for i in range(200))
    return [
        None,
        "",
        "...",
        "CC BY",
        "cc-by 4.0; cc\nBY",
        filler + " All Rights\nReserved. " + filler + " all rights reserved",
        "GNU General Public License, version 3",
        filler[:150] + " Licensed under the Apache License, Version 2.0. " + filler,
        "licensed under apache license version 2.0",
        "licensed apache two",
        "Redistribution and use in source and binary, with or without modification, are permitted",
        ("all rights " * 50) + "reserved",
        " ".join(["general public license"] * 90),
        "free of charge, to any person obtaining a copy of this software is hereby granted",
        "üall rights reservedé all rights reserved",
    ]


def test_against_brute_force(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "all rights reserved", "x"), (3, "CC BY", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, labels string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in license_scan.op8_license_scan(spark, str(tmp_path)).collect()), key=str)
    want = sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert got == want


def test_real_rows_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = license_scan.op8_license_scan(spark, d).collect()
    assert len(out) == len(docs)
    for r in out:
        assert tuple(r)[1:] == brute(docs[r.doc_id])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert license_scan.op8_license_scan(spark, str(tmp_path)).collect() == []


def test_any_frequency_order_gives_the_same_matches():
    text = "x " * 70 + "licensed under the apache license version 2 0 " + "y " * 70
    for freq in ({}, {"the": 9, "under": 8}, {w: 100 - i for i, w in enumerate("licensed apache version license".split())}):
        assert license_scan.Join(freq).scan(text)[3] == ["apache-2.0"]
    assert words("A-b\x00c9É") == [b"a", b"b", "c9É".encode()]
