"""op11 against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from linegauge.llm import simhash
from odd_rows import awkward, nothing, odd, prose  # noqa: F401


def plain_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(len(found) - words + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, bits=3):
    """Least member of the component of each number."""
    nodes = list(nodes)
    of = {n: n for n in nodes}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= bits:
                of[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def expected(rows):
    prints = [(doc_id, plain_fingerprint(text)) for doc_id, text in rows]
    of = plain_components({fp for doc_id, fp in prints if doc_id is not None})
    least = {}
    for doc_id, fp in prints:
        if doc_id is not None:
            least[of[fp]] = min(least.get(of[fp], doc_id), doc_id)
    return sorted(((d, f"{fp:016x}", None if d is None else least[of[fp]]) for d, fp in prints), key=str)


def found(df):
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted(map(tuple, df.collect()), key=str)


def test_awkward_rows(spark, odd, nothing):  # noqa: F811
    assert found(simhash.classes(odd)) == expected([r[:2] for r in awkward()])
    assert found(simhash.classes(nothing)) == []


@pytest.mark.parametrize("hot", [simhash.HOT, 1])
def test_near_copies(spark, hot):
    rnd = random.Random(5)
    rows = []
    for group in range(12):
        text = prose(rnd, 220).split(" ")
        for copy in range(9):
            for _ in range(rnd.choice([0, 1, 1, 2])):
                text[rnd.randrange(len(text))] = prose(rnd, 1)
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = expected(rows)
    assert len({c for _, _, c in want}) < 0.8 * len(rows)
    assert found(simhash.classes(df, hot=hot)) == want


@pytest.mark.parametrize("hot", [simhash.HOT, 3])
def test_dense_fingerprints(spark, hot):
    """Fingerprints around two centres, chains of three bits, all in few variants: links connect just what brute force connects."""
    rng = np.random.default_rng(3)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 2, dtype=np.uint64).tolist():
        for _ in range(150):
            fps.add(centre ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 6)))))
        chain = centre
        for _ in range(10):
            chain ^= sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            fps.add(chain)
    signed = [(fp - (1 << 64) if fp >> 63 else fp,) for fp in fps]
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links_of(spark.createDataFrame(signed, "fp long"), hot=hot).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    of = {n: n for n in fps}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in links:
        of[max(root(a), root(b))] = min(root(a), root(b))
    assert {n: root(n) for n in fps} == plain_components(fps)


def test_links_do_not_grow_with_the_square(spark):
    """Two thousand fingerprints within few bits of each other give few links each."""
    rng = np.random.default_rng(4)
    masks = {sum(1 << int(b) for b in set(rng.integers(0, 24, rng.integers(0, 4)))) for _ in range(2000)}
    df = spark.createDataFrame([(m,) for m in masks], "fp long")
    links = simhash.links_of(df, hot=500).count()
    assert links < 60 * len(masks)


def test_exploded_rows_are_not_broadcast(spark):
    """Spark sizes variants and the numbers near a fingerprint as the fingerprints alone."""
    nodes = spark.range(300).selectExpr("xxhash64(id) AS fp")
    for made in (simhash.shared_variants(nodes), simhash.met(nodes)):
        made.collect()
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
