"""op3, op6, op8, op10 and the pipeline."""

import random
import sys
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import DATA
from linegauge.llm import chat, licenses, nearest, registry, toxicity
from odd_rows import nothing, odd  # noqa: F401
from test_texts import brute_classes, brute_cut

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_twins(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = con.execute(registry.ORACLES[name])
    columns = sorted(c[0] for c in found.description)
    expected = sorted(map(str, found.df()[columns].itertuples(index=False, name=None)))
    got = registry.QUERIES[name](spark, DATA).toPandas()[columns]
    assert sorted(map(str, got.itertuples(index=False, name=None))) == expected and expected


MIT = """Copyright (c) 2020 Somebody.

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
software."""


def test_license_rules(spark, odd, nothing):
    assert all(any(a in s for a in licenses.ANCHORS) for s in licenses.SENTENCES)
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES.values())
    texts = [
        MIT.replace("Permission", "# Permission"),
        "Some words here.\nLicensed under the Apache License, Version 2.0.\nMore.",
        "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License. Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties "
        "of merchantability, fitness for a particular purpose and noninfringement.",
        "Released under the MIT License. This work is licensed under the GNU General Public License, version 3.",
        "A licence is a permission.",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.sentence_ids, r.licenses, r.n_unmatched) for r in licenses.scanned(rows).collect()}
    assert found[0] == (["MITgrant", "MITnotice"], ["MIT"], 0)
    assert found[1] == (["Apache2ref"], ["Apache-2.0"], 0)
    assert found[2] == (["Apache2ref", "ApacheComply", "ApacheBasis"], ["Apache-2.0"], 0)
    assert found[3] == (["MITwarranty"], [], 1)
    assert found[4] == (["MITref", "GPL3ref"], ["GPL-3.0-only", "MIT"], 0)
    assert found[5] == ([], [], 0)
    assert licenses.scanned(odd).count() == odd.count() and licenses.scanned(nothing).count() == 0


GNU = """    This program is free software{a} you can redistribute it and/or modify
    it under the terms of the GNU {kind}General Public License as published by
    the Free Software Foundation{b} either version {n} of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU {kind}General Public License for more details.
"""
WARRANTY = """.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.
"""
APACHE = """Copyright 2020 Somebody

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
CC = "This work is licensed under a Creative\nCommons Attribution{nc} 4.0\nInternational License. To view a copy of this license, visit a page.\n"


def test_published_notices(spark):
    later = "GPL-{}.0-or-later"
    whole_apache = ["Apache2ref", "ApacheComply", "ApacheBasis"]
    bsd = ["BSDgrant", "BSDsource", "BSDbinary"]
    cases = [
        (MIT.rstrip(".") + WARRANTY, ["MITgrant", "MITnotice", "MITwarranty"], ["MIT"]),
        (APACHE, whole_apache, ["Apache-2.0"]),
        (BSD, bsd, ["BSD-2-Clause"]),
        (BSD + ENDORSE, [*bsd, "BSDendorse"], ["BSD-3-Clause"]),
        (ISC, ["ISCgrant"], ["ISC"]),
        (GNU.format(a=";", b=";", kind="", n=2), ["GPL2later"], [later.format(2)]),
        (GNU.format(a=":", b=",", kind="", n=3), ["GPL3later"], [later.format(3)]),
        (GNU.format(a=";", b=";", kind="", n=3), ["GPL3later"], [later.format(3)]),
        (GNU.format(a=":", b=",", kind="Lesser ", n=3), ["LGPL3later"], ["L" + later.format(3)]),
        (GNU.format(a=":", b=",", kind="Affero ", n=3), ["AGPL3later"], ["A" + later.format(3)]),
        (MPL, ["MPL2ref"], ["MPL-2.0"]),
        (CC.format(nc=""), ["CCBY4ref"], ["CC-BY-4.0"]),
        (CC.format(nc="-NonCommercial"), ["CCBYNC4ref"], ["CC-BY-NC-4.0"]),
        ("This work is dedicated to the public domain under the\nCC0 license.", ["CC0ref"], ["CC0-1.0"]),
        ("Licensed under\nCC BY-SA 4.0.", ["CCBYSA4ref"], ["CC-BY-SA-4.0"]),
        ("Licensed under the\nBSD 2-Clause\nLicense.", ["BSD2ref"], ["BSD-2-Clause"]),
        ("Licensed under the\nBSD 3-Clause\nLicense.", ["BSD3ref"], ["BSD-3-Clause"]),
        ("This work is licensed under the\nGNU General Public\nLicense, version 3.", ["GPL3ref"], ["GPL-3.0-only"]),
        ("This work is licensed under the\nGNU General Public\nLicense, version 2.", ["GPL2ref"], ["GPL-2.0-only"]),
        ("Licensed under the GNU Lesser General Public\nLicense, version 3.", ["LGPL3ref"], ["LGPL-3.0-only"]),
        ("Licensed under the GNU Affero General Public\nLicense, version 3.", ["AGPL3ref"], ["AGPL-3.0-only"]),
        ("Notes\nReleased under the\nMIT License\nAbout", ["MITref"], ["MIT"]),
        ("Released under the\n\n---\nMIT License. A text.", ["MITref"], ["MIT"]),
        ("The warranty\nIs not\nLicensed under the MIT", [], []),
    ]
    assert {name for name, _ in licenses.RULES} == {name for _, _, names in cases for name in names}
    styles = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: "/*\n" + "".join(f" * {line}\n" for line in t.split("\n")) + " */"]
    texts = [(k * len(cases) + c, style(case[0])) for k, style in enumerate(styles) for c, case in enumerate(cases)]
    found = {r.doc_id: (r.sentence_ids, r.licenses, r.n_unmatched) for r in licenses.scanned(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for doc_id, text in texts:
        _, ids, names = cases[doc_id % len(cases)]
        assert found[doc_id] == (ids, names, 0), text


def conversation(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid string, turns int, formatted int")


def test_chat_is_read_back(spark):
    rnd = random.Random(1)
    marks = ["\\", "#", "<", "</turn>\n", "### user: ", "\\s", "\\h", "\n", "é", "", ": ", "x"]
    rows, expected = [], {}
    for conv in range(60):
        turns = []
        for turn in range(rnd.randint(1, 6)):
            text = "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 8)))
            turns.append((rnd.choice(["user", "assistant", "system", "tool: #", "tool: search", "a</turn>b", "\\c:", ":", "### "]), text))
            rows.append((conv, turn, *turns[-1], "v", 1, 2))
        expected[conv] = turns
    rnd.shuffle(rows)
    found = chat.read_back(chat.formatted(conversation(spark, rows).repartition(4))).collect()
    for r in found:
        turns = expected[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.loss_text == "".join(b for a, b in turns if a == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
    assert len(found) == 60


def test_chat_twin_counts_the_marks_of_roles(spark, tmp_path):
    rows = [(1, 0, "tool: search", "hi"), (1, 1, "a</turn>b", "x: # <"), (2, 0, "user", "b"), (2, 1, "assistant", ": \\")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = registry.QUERIES["op6_chat"](spark, str(tmp_path))
    twin = con.execute(registry.ORACLES["op6_chat"])
    at = [found.columns.index(c[0]) for c in twin.description]
    assert sorted(twin.fetchall()) == sorted(tuple(r[i] for i in at) for r in found.collect())


def test_chat_order_and_gaps(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", ""), (2, 0, "assistant", "a"), (3, 0, "user", "a"), (3, 1, "user", "b"),
        (4, 5, None, "x"), (None, 0, "user", "n"), (5, 1, "user", "b"), (5, 1, "user", "b"), (5, None, "user", "first"), (6, 0, "user", "a"),
    ]
    df = conversation(spark, [(*r, None, None, None) for r in rows])
    found = {r.conv_id: r for r in chat.read_back(chat.formatted(df)).collect()}
    assert {k: r.valid for k, r in found.items()} == {1: True, 2: False, 3: False, 4: False, None: True, 5: False, 6: True}
    assert [t.text for t in found[1].turns] == ["s", "", ""] and [t.text for t in found[5].turns] == ["first", "b", "b"]
    assert chat.formatted(df.where("false")).count() == 0


def test_chat_plan_is_native(spark):
    plan = registry.QUERIES["op6_chat"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    plan += registry.QUERIES["op3_license_scan"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_nearest(ids, vectors, k):
    made = []
    for i in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((vectors - vectors[i]) ** 2).sum(axis=1))
        others = np.flatnonzero(ids != ids[i])
        for rank, j in enumerate(others[np.lexsort((ids[others], distance[others]))][:k], 1):
            made.append((int(ids[i]), rank, int(ids[j]), float(distance[j])))
    return sorted(made)


def vectors(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    return np.round(rng.normal(size=(8, dim))[rng.integers(0, 8, n)] + rng.normal(size=(n, dim)), 2)


@pytest.mark.parametrize("rows_each", [50, 4096])
def test_factor_one_is_exact(spark, monkeypatch, rows_each):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    monkeypatch.setattr(nearest, "LEAF_ROWS", 8)
    data = vectors(900)
    data[300:420] = data[0]  # copies: ties
    ids = np.arange(900)
    df = spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, data)], "vec_id long, embedding array<double>, shard int")
    rows = nearest.usable(df)
    shards = 900 // rows_each + 1
    found = nearest.search(nearest.index(rows, shards), rows.where("vec_id % 100 = 0"), shards, 10, factor=1.0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute_nearest(ids, data, 10)


@pytest.mark.parametrize("leaf", [8, 128])
def test_a_repeated_candidate_takes_one_place(spark, monkeypatch, leaf):
    monkeypatch.setattr(nearest, "LEAF_ROWS", leaf)
    data = vectors(400)
    # Each vector 12 times, and one id in ten with a second vector of its own.
    rows = [(i, v.tolist()) for i, v in enumerate(data)] * 12 + [(i, (data[i] + 0.5).tolist()) for i in range(5, 400, 10)]
    least = {}
    for q in range(0, 400, 100):
        for i, v in rows:
            if i != q:
                distance = float(np.sqrt(((np.array(v) - data[q]) ** 2).sum()))
                least[q, i] = min(distance, least.get((q, i), distance))
    expected = []
    for q in range(0, 400, 100):
        near = sorted((d, i) for (of, i), d in least.items() if of == q)[:10]
        expected += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    df = nearest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    for shards in (1, 3):
        found = nearest.search(nearest.index(df, shards), df.where("vec_id % 100 = 0"), shards, 10, factor=1.0).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == expected
    # A tree that is given repeated rows keeps different ids too.
    ids, all_rows = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    order, inner, radii = nearest.build_tree(ids, all_rows)
    near, near_ids = nearest.Tree(ids[order], all_rows[order], inner, radii).search(np.array([0]), data[:1], 10, 1.0)
    assert near_ids[0].tolist() == [i for q, _, i, _ in expected if q == 0]


def test_queries_are_not_copied_by_tree(spark):
    """Copies of the queries for each tree were sized as the queries alone, and broadcast."""
    data = vectors(600)
    rows = nearest.usable(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>"))
    found = nearest.search(nearest.index(rows, 40), rows.where("vec_id % 100 = 0"), 40, 10, factor=1.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    exact = data.astype(np.float32).astype(np.float64)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == brute_nearest(np.arange(600), exact, 10)


def test_queries_sent_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 2)
    monkeypatch.setattr(nearest, "SENT_BYTES", 700)
    long, short = vectors(700), vectors(500, dim=4, seed=3)
    both = [(i, v.tolist()) for i, v in enumerate(long)] + [(1000 + i, v.tolist()) for i, v in enumerate(short)]
    rows = nearest.usable(spark.createDataFrame(both, "vec_id long, embedding array<double>"))
    found = nearest.search(nearest.index(rows, 5), rows.where("vec_id % 100 = 0"), 5, 10, factor=1.0).collect()
    expected = brute_nearest(np.arange(700), long, 10) + brute_nearest(np.arange(1000, 1500), short, 10)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == expected


def test_recall_of_the_production_factor(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    ids, data = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    expected = {(q, v) for q, _, v, _ in brute_nearest(ids, data, 10)}
    found = {(r.query_id, r.vec_id) for r in registry.QUERIES["op8_nearest"](spark, DATA).collect()}
    assert len(found & expected) >= 0.95 * len(expected)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 1.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0])]
    rows += [(8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (0, [5.0, 5.0]), (9, [])]
    df = nearest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = nearest.search(nearest.index(df, 2), df.where("vec_id = 0 AND embedding[0] = 1"), 2, 10).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(1, 6, 2.0), (2, 7, 2.0)]
    none = df.where("false")
    assert nearest.search(nearest.index(none, 1), none, 1, 10).count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels = tables
    rows = registry.QUERIES["op10_toxicity"](spark, DATA).join(labels, "doc_id").where("held_out").collect()
    assert rows and sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_a_repeated_doc_id_trains_on_its_least_text(spark):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    rows = [(i, f"{c} text {i}") for c in "bac" for i in range(20)]
    for parts in (1, 5):
        sample = toxicity.training_sample(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), labels)
        assert sample.columns == ["doc_id", "text", "toxic"]
        assert {r.text for r in sample.collect()} == {f"a text {r.doc_id}" for r in sample.collect()} and sample.count() > 10


def test_sample_leaves_the_held_out_fifth_alone(tables):
    import zlib

    docs, labels = tables
    sample = toxicity.training_sample(docs, labels, 50)
    ids = [r.doc_id for r in sample.collect()]
    assert len(ids) == 50 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


def test_toxicity_of_awkward_rows(spark, odd, nothing, tables):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, none)
    assert {r.tox_score for r in model.scored(odd, ["doc_id"]).collect()} == {0.0}
    model = toxicity.fit(*tables)
    kept = toxicity.reject_toxic(odd, model)
    assert kept.schema == odd.schema and kept.count() == odd.count()
    assert toxicity.reject_toxic(nothing, model).count() == 0
    bad = odd.limit(1).withColumn("text", F.lit(" ".join(["You are a", *model.lexicon[:3], "and", *model.lexicon[:6]])))
    assert toxicity.reject_toxic(bad, model).count() == 0


def test_features():
    kinds = toxicity.Kinds(frozenset({"idiot"}))
    row = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT! an 1d1ot, id*ot ok", kinds)))
    assert row["lexicon_count"] == 1 and row["hidden_count"] == 1 and row["near_share"] > 0 and row["capital_words"] > 0
    assert set(toxicity.features("", kinds)) == {0.0}


def test_pipeline_stages(spark, tables):
    import corpus_pipeline as pipeline
    from linegauge.llm import repetition
    from linegauge.llm.common import stored

    docs, labels = tables
    seen, at = [], docs
    for name, stage in pipeline.STAGES:
        out = stored(stage(spark, at, DATA), f"test-{name}")
        seen.append((name, at, out))
        at = out
    names = [n for n, _, _ in seen]
    assert names == ["toxicity", "quality_rules", "jaccard_join", "suffix_dedup", "packing"]
    for _, _, out in seen[:-1]:
        assert out.columns == docs.columns
    toxic = {r.doc_id for r in registry.QUERIES["op10_toxicity"](spark, DATA).where("predicted = 1").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert ids(seen[0][2]) == ids(docs) - toxic
    assert ids(seen[1][2]) == {r.doc_id for r in repetition.quality(seen[1][1]).where("kept").collect()}
    # Stages 3 and 4 against brute force over all pairs and all 200-byte strings of their own inputs.
    classes = brute_classes([(r.doc_id, r.text) for r in seen[2][1].collect()])
    assert ids(seen[2][2]) == set(classes.values())
    given = [(r.doc_id, (r.text or "").encode()) for r in seen[3][1].collect()]
    left = {doc: kept.decode(errors="ignore") for doc, _, _, _, kept in brute_cut(given, 200)}
    assert {str(r.doc_id): r.text for r in seen[3][2].collect()} == left
    assert all(r.n_chars == len(r.text) for r in seen[3][2].collect())
    rows = seen[4][2]
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen[4][1].collect()}
    assert {r.doc_id: r.m for r in rows.groupBy("doc_id").agg(F.max("doc_tokens").alias("m")).collect()} == tokens
    assert {r.doc_id: r.n for r in rows.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == tokens
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    expected = sorted(map(str, rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()))
    again = pipeline.run(spark, DATA).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert sorted(map(str, again.collect())) == expected
