"""op4, op7, op9 against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linegauge.llm import common, graph, jaccard, repetition, suffix_dedup
from odd_rows import nothing, odd, prose  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text, n=4):
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_classes(rows, per_cent=85):
    """doc_id to the smallest doc_id reachable, all pairs compared."""
    sets = [(d, grams(t)) for d, t in rows if d is not None]
    least = {d: d for d, _ in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets:
            for b, y in sets:
                if not x or not y or 100 * min(len(x), len(y)) < per_cent * max(len(x), len(y)):
                    continue
                if 100 * len(x & y) >= per_cent * len(x | y) and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def check_classes(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    least = brute_classes(rows)
    found = jaccard.classes(df).collect()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found)
    assert got == sorted((str(d), len(grams(t)), str(least.get(d))) for d, t in rows)
    return least


def test_classes_of_awkward_rows(odd):
    least = check_classes(odd)
    assert least[7] == 6 and least[8] == 6 and least[9] == 9 and least[5] == 4


def test_classes_of_many_near_copies(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 300)}" for _ in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 9999)}"
        rows.append((i, " ".join(words)))
    # A passage in many texts that are otherwise unlike each other, and a chain of links.
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(1000 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(60))) for i in range(40)]
    rows += [(2000 + i, " ".join(f"c{k}" for k in range(3 * i, 3 * i + 100))) for i in range(12)]
    least = check_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert len({least[1000 + i] for i in range(40)}) == 40 and len({least[2000 + i] for i in range(12)}) == 1


def test_dealt_queries_and_shuffled_sets_change_nothing(odd, monkeypatch):
    monkeypatch.setattr(jaccard, "MERGE_ROWS", 2)
    monkeypatch.setattr(jaccard, "SMALL_ROWS", -1)
    check_classes(odd)


def test_one_of_each_keeps_columns(odd):
    least = brute_classes([(r.doc_id, r.text) for r in odd.collect()])
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    expected = [r for r in odd.collect() if r.doc_id is None or least[r.doc_id] == r.doc_id]
    assert sorted(map(str, kept.collect())) == sorted(map(str, expected))


def test_one_row_of_each_class_passes_both_stages(spark):
    import corpus_pipeline as pipeline

    rnd = random.Random(9)
    texts = [" ".join(f"t{k}w{rnd.randint(0, 10**6)}" for _ in range(100)) for k in range(7)]
    near = texts[1].split(" ")
    near[50] = "changed"
    rows = [(1, texts[0], "a"), (1, texts[0], "a"), (2, texts[1], "a"), (None, texts[1], "b"), (None, " ".join(near), "c"), (2, " ".join(near), "d")]
    rows += [(None, texts[2], "a"), (None, texts[2], "a"), (5, texts[3], "a"), (5, texts[4], "a"), (6, texts[5], "a"), (7, texts[5], "b")]
    rows += [(8, "", "a"), (8, "", "a"), (8, None, "a"), (9, "", "a"), (None, "", "a"), (None, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n_chars", F.char_length("text").cast("long")).repartition(5)
    kept = common.stored(pipeline.without_near_copies(spark, docs, ""), "test-kept")
    assert kept.schema == docs.schema
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    # Of the texts of document 2 either may stay, they are one class.
    second = {k: n for k, n in found.items() if k[0] == 2}
    assert sum(second.values()) == 1 and next(iter(second))[1] in (texts[1], " ".join(near))
    expected = [(1, texts[0]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (6, texts[5]), (8, ""), (8, None), (9, ""), (None, ""), (None, "")]
    assert found - Counter(second) == Counter(expected)
    after = pipeline.without_repeated_passages(spark, kept, "")
    assert Counter((r.doc_id, r.text) for r in after.collect()) == found


def test_two_words_in_all(spark):
    rows = [(1, "one two"), (2, None), (3, ""), (4, " \n")]
    check_classes(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    for words in range(8):
        owner, gram = jaccard.gram_sets(pa.array([None, " ".join("abcdefg"[:words]), ""]), 5)
        assert owner.tolist() == [1] * (max(words - 4, 1) if words else 0)


def test_texts_of_a_repeated_doc_id_link_by_themselves(spark):
    rnd = random.Random(5)

    def near(words, times):
        made = list(words)
        for k in rnd.sample(range(len(made)), times):
            made[k] = f"x{rnd.randint(0, 9999)}"
        return " ".join(made)

    a, b, c = ([f"{x}{i}" for i in range(150)] for x in "abc")
    # 1 has texts of three groups, whose other members do not link with each other.
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(c)), (1, " ".join(c)), (2, near(a, 2)), (3, near(b, 2)), (4, near(c, 2)), (5, " ".join(b))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.component_id) for r in jaccard.classes(df).collect()} == {(i, 1) for i in range(1, 6)}
    _, labels = jaccard.links_and_sets(df, jaccard.Likeness())
    found = labels.groupBy("component").count().collect()
    assert sorted(r["count"] for r in found) == [2, 2, 2]
    # Two texts of one id keep classes of their own where other ids are smaller.
    rows = [(9, " ".join(a)), (9, " ".join(b)), (2, near(a, 2)), (3, near(b, 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id, r.component_id) for r in jaccard.classes(df).collect()) == [(2, 2), (3, 3), (9, 2), (9, 3)]


def test_packed_grams_round_trip():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 500).astype(np.uint64))
    assert jaccard.unpacked_grams(jaccard.packed_grams(values)).tolist() == values.tolist()
    assert len(jaccard.unpacked_grams(jaccard.packed_grams(values[:0]))) == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(5, 45)] + [(100, 101)], "a long, b long")
    found = {r.node: r.component for r in graph.components(links).collect()}
    assert found == {i: 5 for i in range(5, 46)} | {100: 100, 101: 100}


def brute_quality(text):
    words = WORD.findall(text or "")
    n = len(words)
    places = defaultdict(list)
    for i in range(n - 7):
        places[tuple(words[i : i + 8])].append(i)
    repeated = {k for found in places.values() if len(found) > 1 for i in found for k in range(i, i + 8)}
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    longest = 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    failed = n < 20 or 100 * len(repeated) > 30 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, again, len(repeated), failed, longest if longest >= 8 else 0


def test_quality_figures():
    rnd = random.Random(3)
    texts = ["", " \n ", None, "é é", "a\n\na\n a\nb\nb"]
    for k in range(200):
        kinds = "ab é| # x".split(" ") if k % 2 else list("abcdef")
        words = [rnd.choice(kinds) for _ in range(rnd.randint(1, 60))]
        words = words + words[5:25] + words if k % 3 == 0 else words
        words = ["z"] * 50 if k % 7 == 0 else words
        texts.append("".join(w + rnd.choice([" ", "\n", " \t", "\x0b", "\n\n"]) for w in words))
    rows = repetition.measured(pa.array(range(len(texts))), pa.array(texts), repetition.RepetitionLimits()).to_pylist()
    for text, row in zip(texts, rows):
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "longest_repeat"]
        assert tuple(row[c] for c in names) == brute_quality(text), repr(text)
        assert not (row["base_failed"] and row["kept"])


def test_a_long_repeat_in_a_long_text_is_rejected():
    words = [f"w{i}" for i in range(1000)]
    limits = repetition.RepetitionLimits(covered=1.0, longest=100, longest_share=0.1)
    texts = [" ".join(words), " ".join(words + words[:120]), " ".join(words + words[:90])]
    rows = repetition.measured(pa.array([0, 1, 2]), pa.array(texts), limits).to_pylist()
    assert [(r["longest_repeat"], r["base_failed"], r["kept"]) for r in rows] == [(0, False, True), (120, False, False), (90, False, True)]


def test_quality_of_awkward_rows(odd, nothing):
    rows = repetition.quality(odd).collect()
    assert len(rows) == odd.count()
    kept = Counter(r.doc_id for r in rows if r.kept)
    good = repetition.keep_good(odd)
    assert good.schema == odd.schema and Counter(r.doc_id for r in good.collect()) == kept
    assert repetition.quality(nothing).count() == 0


def brute_cut(rows, span):
    """(doc_id, bytes) to what is left, every window counted."""
    seen = Counter(t[i : i + span] for _, t in rows for i in range(len(t) - span + 1))
    made = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - span + 1):
            if seen[text[i : i + span]] > 1:
                gone[i : i + span] = True
        pieces = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        made.append((str(doc), len(text), int(gone.sum()), pieces, bytes(np.frombuffer(text, np.uint8)[~gone])))
    return sorted(made)


@pytest.mark.parametrize("hot", [20_000, 0, 1])
@pytest.mark.parametrize("span", [200, 40])
def test_repeated_strings_go(odd, monkeypatch, hot, span):
    monkeypatch.setattr(suffix_dedup, "BUCKET_PHRASES", 3)
    docs = suffix_dedup.marked(odd)
    made = suffix_dedup.cut_texts(docs, suffix_dedup.repeated_spans(docs, span, hot), span).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in made)
    assert got == brute_cut([(r.doc_id, (r.text or "").encode()) for r in odd.collect()], span)


def cut_like_brute(spark, rows, span=200):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = suffix_dedup.marked(df)
    spans = suffix_dedup.repeated_spans(docs, span)
    made = suffix_dedup.cut_texts(docs, spans, span).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in made)
    return got == brute_cut([(d, (t or "").encode()) for d, t in rows], span), spans


def test_texts_of_one_doc_id_with_a_short_hash_in_common(spark):
    """Two texts without doc_id whose 32-bit hashes are equal, one of them shorter than the spans of the other."""
    many = spark.range(0, 200_000).selectExpr("id", "concat(repeat(concat('w', id, ' '), CASE WHEN id % 2 = 0 THEN 30 ELSE 120 END), 'end') AS text")
    twice = many.groupBy(F.hash("text").alias("h")).agg(F.count("*").alias("n"), F.min(F.struct(F.length("text"), "text")).alias("a"), F.max(F.struct(F.length("text"), "text")).alias("b"))
    pair = twice.where("n > 1").orderBy(F.expr("length(a.text) - length(b.text)")).first()
    short, long = pair.a.text, pair.b.text
    assert short != long
    right, _ = cut_like_brute(spark, [(None, short), (None, long), (5, long), (None, "unlike " * 40)])
    assert right


def test_many_equal_rows_stay_linear(spark):
    """2,000 rows of one null-id text share one set of spans, each span once; the phrases of one of them are read."""
    rnd = random.Random(6)
    base, other = prose(rnd, 150), prose(rnd, 40)
    page = f"{base} {other} {base[:400]}"
    rows = [(None, page)] * 2000 + [(1, f"{prose(rnd, 60)} {base} {prose(rnd, 60)}"), (2, prose(rnd, 300))]
    right, spans = cut_like_brute(spark, rows)
    assert right
    assert max(len(r.entries) for r in spans.collect()) < len(page)
    docs = suffix_dedup.marked(spark.createDataFrame(rows, "doc_id long, text string"))
    assert suffix_dedup.once(docs, suffix_dedup.parse(docs, 200)).count() == 3


def test_texts_without_repeats(odd):
    made = suffix_dedup.without_repeats(odd)
    assert made.schema == odd.schema and made.count() == odd.count()
    left = {d: t for d, _, _, _, t in brute_cut([(r.doc_id, (r.text or "").encode()) for r in odd.collect()], 200)}
    for r in made.where("doc_id IS NOT NULL").collect():
        assert (r.text or "") == left[str(r.doc_id)].decode(errors="ignore")
    assert made.where("doc_id = 0").first().text is None


def test_empty_tables(nothing):
    assert jaccard.classes(nothing).count() == 0 and jaccard.one_of_each(nothing).count() == 0
    docs = suffix_dedup.marked(nothing)
    assert suffix_dedup.cut_texts(docs, suffix_dedup.repeated_spans(docs)).count() == 0


def test_slices_cut_no_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 50, "c", "d" * 3], "k": [1, 2, 3, 4, 5]})
    parts = list(common.slices([batch, batch.slice(0, 0)], limit=12))
    assert [k for p in parts for k in p.column("k").to_pylist()] == [1, 2, 3, 4, 5]
    assert len(parts) == 2


def test_scratch_of_finished_steps_is_removed(spark, odd, tmp_path, monkeypatch):
    """What the result does not read is gone; the result can still be computed, twice."""
    count = iter(range(1000))
    monkeypatch.setattr(common, "scratch_dir", lambda _, label: f"{tmp_path}/{label}.{next(count)}")
    left = lambda: sorted(p.name.split(".")[0] for p in tmp_path.iterdir())
    docs = suffix_dedup.marked(odd)
    spans = suffix_dedup.repeated_spans(docs)
    assert left() == ["spans"]
    assert sorted(map(str, spans.collect())) == sorted(map(str, spans.collect()))
    sets, labels = jaccard.links_and_sets(odd, jaccard.Likeness())
    assert left() == ["labels", "nodes", "sets", "spans"]
    assert labels.count() == labels.count() > 0 and sets.count() == odd.count()

def test_lists_are_merged_as_plain_rows(spark):
    """No row holds the lists of a query, and a query may go on in the next batch."""
    rnd = random.Random(2)
    rows = sorted({(q, t, c) for q in range(40) for t in range(rnd.randint(1, 9)) for c in rnd.sample(range(3000), rnd.randint(1, 900))})
    given = spark.createDataFrame(rows, "query long, token long, candidate long")
    found = jaccard.merged(given, 2)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    times = Counter((q, c) for q, _, c in rows)
    assert sorted(tuple(r) for r in found.collect()) == sorted((q, c, n) for (q, c), n in times.items() if n > 1)


def test_words_are_hashed_at_once(monkeypatch):
    """Equal words, A-Z lower-cased, have equal hashes and others have not; only long words are hashed one by one."""
    rnd, calls = random.Random(21), []
    plain = jaccard.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(jaccard.xxhash, "xxh3_64_intdigest", lambda data: calls.append(len(data)) or plain(data))
    words = ["".join(rnd.choice("abAB01é\x00\x1f\x85") for _ in range(n)) for n in [*range(1, 20), 63, 64, 65, 66, 200] for _ in range(12)]
    words += ["a" * n for n in range(1, 70)] + ["a" + "\x00" * n for n in range(1, 70)]
    texts = [rnd.choice(" \t\n\v\f\r").join(rnd.choices(words, k=rnd.randint(0, 40))) for _ in range(300)] + [None, "", " ", "ab", "cd"]
    whole = pa.array([*texts, "one more"])
    for column in (whole.slice(0, len(texts)), whole.slice(7, len(texts) - 7), whole.cast(pa.large_string()).slice(7, len(texts) - 7)):
        expected = [(i, w) for i, t in enumerate(column.to_pylist()) for w in WORD.findall((t or "").translate(FOLD))]
        owner, hashed = jaccard.word_hashes(column)
        assert owner.tolist() == [i for i, _ in expected]
        pairs = set(zip(hashed.tolist(), (w for _, w in expected)))
        assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})
    assert min(calls) > jaccard.LONG_WORD
    calls.clear()
    jaccard.gram_sets(pa.array([" ".join(f"w{i}" for i in range(500))]), 4)
    assert not calls


def test_join_passes_small_batches(spark, odd, monkeypatch):
    """Texts reach Python in batches bounded by bytes in every step of the join, and the session's own bound is back afterwards."""
    key, seen, stored = "spark.sql.execution.arrow.maxBytesPerBatch", [], jaccard.stored
    before = spark.conf.get(key)
    monkeypatch.setattr(jaccard, "stored", lambda df, label: seen.append(spark.conf.get(key)) or stored(df, label))
    jaccard.links_and_sets(odd.limit(5), jaccard.Likeness())
    assert len(seen) > 5 and {int(x) for x in seen} == {common.BATCH_BYTES} and spark.conf.get(key) == before

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    measured = common.in_small_batches(lambda docs: [r.n for r in docs.mapInArrow(sizes, "n long").collect()])
    found = measured(spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) AS text"))
    assert sum(found) > 30_000_000 and max(found) < common.BATCH_BYTES + 100_000
