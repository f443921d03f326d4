import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowguard.llm import licences, near_dup, revisits

RECORDS = ("record_id long, record_type string, target_uri string, captured long, status int, headers map<string,string>, "
           "payload_digest string, slice string, stored int")
URL = "http://www.Site.example:80/a/?b=2&utm_source=x&a=1#top"


def test_revisits_take_the_latest_earlier_full_response(spark):
    rows = [
        (1, "response", URL, 100, 200, {"ETag": '"x"', "Content-Type": "text/html", "Date": "d1"}, "p1", "", 0),
        (2, "response", "https://site.example/a?a=1&b=2", 5000, 200, {"ETag": '"y"'}, "p2", "", 0),
        (3, "revisit", "https://site.example/a/?a=1&b=2", 4000, 304, {"etag": 'W/"x"', "date": "d2", "content-type": "no"}, None, "", 0),
        (4, "revisit", URL, 9000, 304, {"ETag": '"x"'}, None, "", 0),
        (5, "revisit", URL, 5000, 304, None, None, "", 0),
        (6, "revisit", URL, 50, 304, {}, None, "", 0),
        (7, "revisit", None, 9000, 304, {}, None, "", 0),
        (8, "revisit", URL, None, 304, {}, None, "", 0),
        (9, "response", URL, 8000, 404, {}, "p3", "", 0),
        (10, "revisit", URL, 90000, 304, {"ETag": '"y"'}, None, "", 0),
        (10, "revisit", URL, 90000, 304, {"ETag": '"y"'}, None, "", 0),
        (None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, RECORDS)
    out = revisits.resolve(df).collect()
    got = {r["record_id"]: (r["verdict"], r["refers_to"], r["payload_digest"]) for r in out}
    assert got == {3: ("resolved", 1, "p1"), 4: ("changed", None, None), 5: ("resolved", 1, "p1"),
                   6: ("no_capture", None, None), 7: ("no_capture", None, None), 8: ("no_capture", None, None),
                   10: ("resolved", 2, "p2")} and len(out) == 8
    headers = {tuple(h) for r in out if r["record_id"] == 3 for h in r["headers"]}
    assert headers == {("etag", 'W/"x"'), ("date", "d2"), ("content-type", "text/html")}
    assert revisits.resolve(df.limit(0)).count() == 0


def test_canonical_addresses(spark):
    same = [URL, "https://site.example/a?a=1&b=2", "HTTP://SITE.example/a/?a=1&&b=2&fbclid=7"]
    df = spark.createDataFrame([(u,) for u in [*same, "no address", None, "http://h"]], "u string")
    got = [r[0] for r in df.select(revisits.canonical(F.col("u"))).collect()]
    assert got == ["site.example/a?a=1&b=2"] * 3 + ["no address", None, "h"]


def test_licences_and_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c/x.py", "print(1)"), (3, "a/b/COPYING.txt", "Preamble\n" + gpl), (4, "a/y.py", None),
        (5, "a/b/z.py", "# " + mit + "\ncode"), (6, "q/x.py", "nothing"), (7, None, mit), (8, "a/b/c/x.py", ""),
        (8, "a/b/c/x.py", ""), (9, "ab/x.py", "licence unknown to all"), (None, "a/n.py", "x"), (10, "top.py", "x"),
    ]
    df = spark.createDataFrame(rows, "file_id long, path string, text string")
    out = licences.scan(df.withColumn("folder", F.lit(1)).withColumn("own", F.lit("x"))).collect()
    got = {r["file_id"]: (r["licence"], r["origin"], r["licence_folder"]) for r in out}
    assert len(out) == len(rows)
    assert got[1] == ("MIT", "own", None) and got[2] == ("GPL-3.0", "inherited", "a/b") == got[8]
    assert got[3] == ("GPL-3.0", "own", None) and got[4] == ("MIT", "inherited", "a") == got[None]
    assert got[5] == ("MIT", "own", None)
    assert got[6] == got[7] == got[9] == got[10] == (None, None, None)
    assert licences.scan(df.limit(0)).count() == 0


def test_every_template_is_its_own_nearest(spark):
    df = spark.createDataFrame([(i, f"{n}.py", f"x\n  {t}  \ny") for i, (n, t) in enumerate(licences.TEMPLATES)],
                               "file_id long, path string, text string")
    assert all(r["path"] == f"{r['own']}.py" and r["score"] == pytest.approx(1) for r in licences.scan(df).collect())


APACHE_HEADER = """/*
 * Copyright 2019 The Example Authors. All rights reserved.
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     https://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
package org.example;
"""
GPL_HEADER = """# Example - a tool
# Copyright (C) 2011  A. Author
#
# This program is free software; you can redistribute it and/or
# modify it under the terms of the GNU General Public License
# as published by the Free Software Foundation; either version {v}
# of the License, or (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
import sys
"""
MPL_HEADER = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */
int main() { return 0; }
"""


def test_licences_of_headers_tags_and_full_texts(spark):
    prose = "one two three four five six seven eight nine ten eleven twelve " * 20
    text = {(n, k): t for n, k, t in licences.licence_texts()}
    mit = text["MIT", "full"].split("\n", 2)[2]
    bsd = "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + text["BSD-3-Clause", "full"]
    cases = [
        ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"), ("# SPDX-License-Identifier: MIT", "MIT"),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"), ("<!-- SPDX-License-Identifier: mit -->", "MIT"),
        ("// SPDX-License-Identifier: Zlib\n", "Zlib"), ("# SPDX-License-Identifier: MIT OR Apache-2.0\n", "MIT OR Apache-2.0"),
        (APACHE_HEADER, "Apache-2.0"), (GPL_HEADER.format(v=3), "GPL-3.0"), (GPL_HEADER.format(v=2), "GPL-2.0"),
        (MPL_HEADER, "MPL-2.0"), (prose + "Released under the MIT License. " + prose, "MIT"),
        (prose + "is Released under the MIT License and more " + prose, "MIT"), ("Copyright (c) 2015 A Person\n\n" + mit, "MIT"),
        (bsd, "BSD-3-Clause"), ("x = 1\n\n" + "".join(f"# {x}\n" for x in bsd.split("\n")) + "\nimport os\n" + prose, "BSD-3-Clause"),
        (prose + "the licence of this is unknown", None), ("GNU GENERAL PUBLIC LICENSE", None), ("BSD License", None)]
    rows = [(i, f"d{i}/f.c", t, w) for i, (t, w) in enumerate(cases)]
    rows += [(1000 + i, f"l{i}/COPYING", t, n) for i, ((n, k), t) in enumerate(sorted(text.items())) if k == "full"]
    rows += [(2000 + i, f"h{i}/x.py", "".join(f"# {x}\n" for x in t.split("\n")) + "import os\n", n)
             for i, ((n, k), t) in enumerate(sorted(text.items())) if k == "header"]
    df = spark.createDataFrame(rows, "file_id long, path string, text string, want string")
    got = {r["file_id"]: r["own"] for r in licences.scan(df).collect()}
    assert [(r[1], r[3], got[r[0]]) for r in rows if got[r[0]] != r[3]] == []


SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark, tmp_path):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "sharding":
            assert out.columns == first.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        steps.append(docs)
    raw, good, single, clean, mixed, shards = ([r.asDict() for r in s.collect()] for s in steps)
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = lambda rows: {r["doc_id"] for r in rows}
    labelled = [d for d in ids(raw) if d in quality]
    assert sum((d in ids(good)) == (quality[d] == 1) for d in labelled) >= 0.97 * len(labelled)

    comp = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(steps[1], percent=80).collect()}
    assert ids(single) == set(comp.values())
    bench = [r["text"].lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    runs = [{tuple(b[i:i + 5]) for i in range(len(b) - 4)} for b in bench]

    def leaks(text):
        w = text.lower().split()
        mine = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        return any(r and len(r & mine) >= 0.9 * len(r) for r in runs)

    assert ids(clean) <= ids(single) and not any(leaks(r["text"]) for r in clean)
    assert all(leaks(r["text"]) or r["doc_id"] in ids(clean) for r in single if not any(
        set(x) & {tuple(r["text"].lower().split()[i:i + 5]) for i in range(len(r["text"].split()))} for x in runs))
    words, share = collections.Counter(), collections.Counter()
    for r in mixed:
        words[r["source"]] += len(r["text"].encode().split())
    for r in clean:
        share[r["source"]] += len(r["text"].encode().split())
    assert sum(words.values()) == pytest.approx(1.5 * sum(share.values()), rel=0.01)
    assert all(words[s] <= 2 * share[s] for s in words)
    assert collections.Counter((r["doc_id"], r["text"]) for r in shards) == collections.Counter((r["doc_id"], r["text"]) for r in mixed)
    slots = collections.defaultdict(list)
    for r in shards:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_stages_take_edge_rows(spark, edge, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge, SF)
        assert set(edge.columns) <= set(out.columns) or name == "sharding"
        out.collect()
        assert stage(spark, empty, SF).count() == 0
