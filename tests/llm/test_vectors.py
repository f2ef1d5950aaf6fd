"""op12 and op13 against plain numpy and plain Python."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from linegauge.llm import registry, trie_codes, whitening

DATA = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, x int, place int, part int"


def awkward(length=8, rows=90, seed=2):
    """Vectors with nulls, NaN, infinity, other lengths, repeated rows and ids, hot copies, null labels and ids; columns with clashing names."""
    rng = np.random.default_rng(seed)
    data = np.round(rng.normal(0, 0.3, (rows, length)), 2).astype(np.float32)
    data[30:60] = data[3]
    found = [(int(i), [float(c) for c in v], None if i % 7 == 0 else int(i % 3), 1, 2, 3) for i, v in enumerate(data)]
    one = found[5][1]
    found += [found[4], (4, found[9][1], 1, 1, 2, 3), (None, one, None, 1, 2, 3), (200, None, 1, 1, 2, 3), (201, [], 1, 1, 2, 3), (202, [1.0], 1, 1, 2, 3)]
    return found + [(203, [math.nan] + one[1:], 1, 1, 2, 3), (-5, [math.inf] + one[1:], 1, 1, 2, 3), (-6, [None] + one[1:], 1, 1, 2, 3)]


def usable(rows):
    lengths = [len(r[1]) for r in rows if r[1]]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 0
    return [r for r in rows if r[1] and len(r[1]) == length and all(c is not None and math.isfinite(c) for c in r[1])]


def plain_codes(rows, parts=4, entries=256):
    """Everything by loops over rows and entries."""
    kept = [(r[0], [math.floor(1024 * float(np.float32(c))) for c in r[1]], r[2]) for r in usable(rows)]
    width = len(kept[0][1]) // parts
    least = {}
    for vec_id, x, _ in kept:
        if vec_id is not None:
            least[vec_id] = min(least.get(vec_id, x), x)
    first = [least[v] for v in sorted(least)[:entries]]
    books = [[x[p * width : (p + 1) * width] for x in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(4):
        for p in range(parts):
            groups = {}
            for _, x, _ in kept:
                part = x[p * width : (p + 1) * width]
                groups.setdefault(nearest(part, books[p])[1], []).append(part)
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else entry for e, entry in enumerate(books[p])]
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    out = []
    for vec_id, x, label in kept:
        found = [nearest(x[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        out.append((vec_id, bytes(e for _, e in found).hex(), sum(d for d, _ in found), label))
    by_label = {}
    for _, _, error, label in out:
        by_label[label] = by_label.get(label, 0) + error
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((v, code, error, by_label[label], sha) for v, code, error, label in out), key=str)


def table(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.mark.parametrize("run", [trie_codes.RUN, 4])
def test_codes_of_awkward_rows(spark, tmp_path, monkeypatch, run):
    monkeypatch.setattr(trie_codes, "RUN", run)
    rows = awkward()
    df = registry.QUERIES["op13_trie_codes"](spark, table(spark, rows, tmp_path))
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, df.collect()), key=str) == plain_codes(rows)


def test_codes_of_many_vectors(spark, tmp_path):
    """More vectors than entries, so rounds move entries; ties and unused entries occur."""
    rng = np.random.default_rng(8)
    rows = [(int(i) * 3, [float(c) for c in v], int(i % 2), 1, 2, 3) for i, v in enumerate(rng.integers(-3, 4, (700, 8)) / 16)]
    df = registry.QUERIES["op13_trie_codes"](spark, table(spark, rows, tmp_path))
    assert sorted(map(tuple, df.collect()), key=str) == plain_codes(rows)


def test_trie_equals_brute_force():
    rng = np.random.default_rng(1)
    parts = np.unique(rng.integers(-4, 5, (3000, 5)), axis=0)
    book = rng.integers(-4, 5, (256, 5))
    entry, distance = trie_codes.nearest_entries(parts, book)
    every = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_decoded_vectors_are_near(spark, tmp_path):
    rows = awkward()
    codes, books = trie_codes.compressed(spark.read.parquet(table(spark, rows, tmp_path) + "/embeddings.parquet"))
    back = {r.vec_id: r.embedding for r in trie_codes.decoded(codes, books).where("vec_id BETWEEN 5 AND 80").collect()}
    errors = {r.vec_id: r.error for r in codes.where("vec_id BETWEEN 5 AND 80").collect()}
    for r in rows[5:81]:
        whole = np.floor(1024 * np.array(r[1], np.float32).astype(float))
        assert round(((whole - 1024 * np.array(back[r[0]])) ** 2).sum()) == errors[r[0]]


def test_uneven_length_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        trie_codes.compressed(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 0)], "vec_id long, embedding array<float>, label int"))


def check_whitened(rows, found, components=32):
    kept = usable(rows)
    c = np.array([[float(np.float32(v)) for v in r[1]] for r in kept])
    x = np.floor(64 * c).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum(int(v) ** 2 for v in row) for row in n * x - sums]
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, len(values))
    assert len(found) == n * k
    by_component = {}
    for r in found:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, k + 1))
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error <= 1e-4
    order = sorted(range(n), key=lambda i: (str(kept[i][0]), deviation[i]))
    for j in range(k):
        got = sorted(by_component[j + 1], key=lambda r: (str(r.vec_id), r.deviation))
        assert [(r.vec_id, r.n, r.deviation) for r in got] == [(kept[i][0], n, deviation[i]) for i in order]
        assert abs(got[0].explained / (values[j] / values.sum()) - 1) < 1e-6 or values[j] < 1e-9 * values[0]
        if values[j] > 1e-9 * values[0]:
            want = (centred @ vectors[:, j] / np.sqrt(values[j]))[order]
            white = np.array([r.whitened for r in got])
            assert min(np.abs(white - want).max(), np.abs(white + want).max()) < 1e-6


def test_whitening_of_awkward_rows(spark, tmp_path):
    rows = awkward()
    df = registry.QUERIES["op12_whitening"](spark, table(spark, rows, tmp_path))
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(rows, df.collect())


def test_whitening_of_a_table_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 32)
    monkeypatch.setattr(whitening, "BLOCKS_A_SPLIT", 2)
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    check_whitened(rows, registry.QUERIES["op12_whitening"](spark, DATA).collect())


def test_whitening_without_variance(spark):
    rows = [(i, [1.0, float(i % 2), 2.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whitened(df).collect()
    assert {r.component for r in found if r.whitened is not None} == {1} and {r.explained for r in found} == {1.0, 0.0}
    same = whitening.whitened(df.where("vec_id < 1")).collect()
    assert [r.whitened for r in same] == [None] * 3 and [r.deviation for r in same] == [0] * 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert whitening.whitened(none).collect() == []
    codes, books = trie_codes.compressed(none)
    assert codes.collect() == [] and books.size == 0


def test_sql_twin(spark, tmp_path):
    """The twin agrees with the loops on awkward rows, and with the query on the whole table."""
    rows = awkward()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{table(spark, rows, tmp_path)}/embeddings.parquet/*.parquet'")
    assert sorted(duck.execute(registry.ORACLES["op13_trie_codes"]).fetchall(), key=str) == plain_codes(rows)
    duck.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    found = registry.QUERIES["op13_trie_codes"](spark, DATA)
    assert sorted(duck.execute(registry.ORACLES["op13_trie_codes"]).fetchall(), key=str) == sorted(map(tuple, found.collect()), key=str)
