"""The digest index, line dedup and the license scan against SQL and brute force."""

import hashlib
import textwrap
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stakescore import staging
from stakescore.llm import digest_index, license_scan, license_texts, line_dedup
from stakescore.llm.catalog import registered
from stakescore.llm.oracle import statements
from tests.conftest import TESTDATA, rows_of
from tests.llm.conftest import ODD_TEXTS


@pytest.mark.parametrize("name", sorted(statements()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_queries_with_sql(spark, duck_at, sf, name):
    got = registered()[name](spark, f"{TESTDATA}/{sf}")
    columns = ", ".join(f'"{c}"' for c in sorted(got.columns))
    want = duck_at(sf).sql(f"SELECT {columns} FROM ({statements()[name]})").fetchall()
    assert rows_of(got) == sorted(want, key=repr)


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.fixture
def index(spark):
    return digest_index.DigestIndex(spark, staging.staging_path(spark, "index"), buckets=4)


@pytest.mark.parametrize("loads", [1, 2, 5])
def test_the_largest_id_of_equal_texts_stays(docs_of, index, loads):
    rows = list(enumerate(ODD_TEXTS)) + [(100 + i, t) for i, t in enumerate(ODD_TEXTS[:9])] + [
        (50, "same"), (51, "same"), (51, "same"), (52, "Same"), (None, "only null"), (None, "same"),
    ]
    got = digest_index.exact_duplicates(docs_of(rows), index, loads)
    largest, sizes = {}, Counter(t or "" for _, t in rows)
    for i, t in rows:
        largest[t or ""] = max((x for x in (i, largest.get(t or "")) if x is not None), default=None)
    want = [(i, largest[t or ""], sizes[t or ""], i == largest[t or ""], sha(t)) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_no_documents_to_index(docs_of, index):
    assert digest_index.exact_duplicates(docs_of([]), index).collect() == []


def test_an_index_goes_on_where_it_was(spark, docs_of, index):
    digest_index.exact_duplicates(docs_of([(7, "old"), (8, "both")]), index).collect()
    again = digest_index.DigestIndex(spark, index.path, buckets=4)
    got = digest_index.exact_duplicates(docs_of([(9, "both"), (10, "new"), (11, "new")]), again)
    assert rows_of(got, "doc_id", "keep_id", "kept") == [(10, 11, False), (11, 11, True), (9, 8, False)]
    assert again.rows().count() == 3


def test_the_index_is_joined_in_its_buckets(spark, docs_of, index):
    index.add(digest_index.digests(docs_of([(i, f"text {i}") for i in range(50)])))
    known = spark.table(index.table).select("digest").hint("merge")
    new = digest_index.digests(docs_of([(1, "text 1"), (2, "other")])).groupBy("digest").agg(F.max("doc_id"))
    plan = new.join(known, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan parquet spark_catalog"):]
    assert "Bucketed: true" in scan and "SortMergeJoin" in plan


def plain_lines(rows, ratio, least):
    """Rows (doc_id, text, host) without their host's boilerplate, in plain Python."""
    hosts, pages = Counter(h for _, _, h in rows if h is not None), defaultdict(Counter)
    for _, text, host in rows:
        if host is not None and text is not None:
            pages[host].update({line.strip(" \t\r") for line in text.split("\n")})
    out = []
    for i, text, host in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if host is None or not x.strip(" \t\r")
                or pages[host][x.strip(" \t\r")] < least or pages[host][x.strip(" \t\r")] <= ratio * hosts[host]]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_lines_are_dropped_by_their_share_of_the_host(docs_of):
    rows = [(i, f"menu\nbody {i}\n\n menu \t\nfoot{i % 4}\nbody {i}", "a") for i in range(40)]
    rows += [(100 + i, f"menu\nown {i}", "b") for i in range(2)] + [(200 + i, "menu\nfoot1", None) for i in range(5)]
    rows += [(300 + i, t, "odd") for i, t in enumerate(ODD_TEXTS)] + [(400, "menu", "a"), (5, "menu\nbody 5", "a"), (5, "menu\nbody 5", "a")]
    rows += [(None, "menu\nrest", "a"), (None, None, "a")]
    for ratio, least in ((0.05, 3), (0.3, 3), (0.9, 1), (0.05, 1)):
        got = line_dedup.drop_boilerplate(docs_of([(i, t, None, h) for i, t, h in rows]), "source", ratio=ratio, min_pages=least)
        assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr) == plain_lines(rows, ratio, least)
        assert {"ids", "page", "shard"} < set(got.columns)


def test_no_pages(docs_of):
    assert line_dedup.drop_boilerplate(docs_of([]), "source").collect() == []


def test_native_operators_run_no_python(spark, sf_dir):
    for name in ("op6_license_scan", "op7_line_dedup"):
        plan = registered()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_host_of(spark):
    urls = spark.createDataFrame([("http://M.Example.com/a?b",), ("no url",), (None,)], "url string")
    assert [r[0] for r in urls.select(line_dedup.host_of(F.col("url"))).collect()] == ["m.example.com", None, None]


FILES = [
    ("src/LICENSE", "Some project\nReleased under the MIT License.\nmore text"),
    ("src/lib/a.c", "code\nLicensed under the Apache License, Version 2.0.\ncode"),
    ("src/lib/b.c", "nothing here"), ("src/lib/deep/er/c.c", None), ("src/lib/deep/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    ("other/d.c", "of the and to"), ("e.c", ""), ("src", "a file at the top"), (None, "Released under the MIT License."),
    ("src/lib/b.c", "nothing here"), ("long/f.txt", "word " * 20000 + "\nLicensed under CC BY-NC 4.0."),
]


def test_licences_are_found_and_inherited(spark):
    frame = spark.createDataFrame([(p, t, "x", 1) for p, t in FILES], "path string, text string, licence string, word int")
    got = sorted(((r["path"], r["licence"], r["how"], r["source"]) for r in license_scan.licences(frame).collect()), key=repr)
    assert got == sorted([
        ("src/LICENSE", "MIT", "notice", "src/LICENSE"), ("src/lib/a.c", "Apache-2.0", "notice", "src/lib/a.c"),
        ("src/lib/b.c", "MIT", "inherited", "src/LICENSE"), ("src/lib/b.c", "MIT", "inherited", "src/LICENSE"),
        ("src/lib/deep/er/c.c", "GPL-3.0", "inherited", "src/lib/deep/COPYING"),
        ("src/lib/deep/COPYING", "GPL-3.0", "notice", "src/lib/deep/COPYING"),
        ("other/d.c", None, None, None), ("e.c", None, None, None), ("src", None, None, None), (None, None, None, None),
        ("long/f.txt", "CC-BY-NC-4.0", "notice", "long/f.txt"),
    ], key=repr)


def test_common_words_beside_a_notice_weigh_little(spark):
    """Words of every file have the least weight, so a notice that shares its line with them is found."""
    rows = [(f"d/{i}.txt", f"lorem ipsum dolor sit amet own{i}") for i in range(200)]
    rows += [("d/mit.c", "lorem ipsum dolor sit Released under the MIT License."), ("d/gpl.c", "lorem ipsum dolor sit amet lorem ipsum "
             "This work is licensed under the GNU General Public License, version 3.")]
    got = {r["path"]: r["licence"] for r in license_scan.licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {p: x for p, x in got.items() if x} == {"d/mit.c": "MIT", "d/gpl.c": "GPL-3.0"}


GPL_HEADER = """/*
 * Frobnicate the input.
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return frob(); }
"""
HASH_HEADER = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
import os
"""
GPL_TITLE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble

  The license is a free, copyleft license for other kinds of works.
"""


def test_headers_and_whole_licences_are_found(spark):
    """Texts over many lines, of which no line alone is a notice."""
    wrapped = {name: textwrap.fill(text, 60) for name, text in reversed(license_texts.TEXTS) if name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC")}
    rows = [(f"d/{i}.txt", f"lorem ipsum dolor sit amet own{i}") for i in range(200)]
    rows += [(f"{name}/LICENSE", f"The project\n\nCopyright (c) 2020 Some Body\n\n{text}\n") for name, text in wrapped.items()]
    rows += [("g/main.c", GPL_HEADER), ("h/main.py", HASH_HEADER), ("t/COPYING", GPL_TITLE)]
    got = {r["path"]: r["licence"] for r in license_scan.licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {p: x for p, x in got.items() if x} == {f"{name}/LICENSE": name for name in wrapped} | {
        "g/main.c": "GPL-3.0", "h/main.py": "Apache-2.0", "t/COPYING": "GPL-3.0"}


def test_a_null_doc_id_has_no_number(spark, docs_of, tmp_path):
    docs_of([(None, "some text", "en", "src6"), (7, "some text", "en", "src6")]).write.parquet(str(tmp_path / "documents.parquet"))
    got = registered()["op6_license_scan"](spark, str(tmp_path))
    assert rows_of(got, "doc_id", "path") == [(7, "src6/en/file.7"), (None, "src6")]


def test_no_files(spark):
    assert license_scan.licences(spark.createDataFrame([], "path string, text string")).collect() == []


def test_telling_words_leave_out_only_what_cannot_reach_the_threshold():
    vectors = [{"the": 1.0, "mit": 5.0, "license": 3.0}, {"the": 1.0, "gnu": 6.0}]
    kept = license_scan.telling(vectors, 0.75)
    for vector in vectors:
        norm = sum(x * x for x in vector.values()) ** 0.5
        rest = sum(x * x for w, x in vector.items() if w not in kept) ** 0.5
        assert rest < 0.75 * norm
    assert "the" not in kept and "mit" in kept and "gnu" in kept


def test_a_load_writes_one_file_for_each_bucket_however_it_is_dealt(spark, docs_of, monkeypatch):
    """As the digests were dealt out, each of many tasks wrote a file for every bucket."""
    frame, dealt = type(spark.range(0)), type(spark.range(0)).repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *by: dealt(self, max(n, 37) if by else n, *by))
    index = digest_index.DigestIndex(spark, staging.staging_path(spark, "digest-index"), buckets=8)
    got = digest_index.exact_duplicates(docs_of([(i, f"text {i % 200}") for i in range(400)]), index, loads=2).collect()
    assert len(got) == 400 and sum(r["kept"] for r in got) == 200
    assert len(index.rows().inputFiles()) <= 2 * 8
    known = spark.table(index.table)
    assert known.select(F.countDistinct("digest")).first()[0] == known.count() == 200
