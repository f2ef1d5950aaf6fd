"""op1, op2, op5: ids against the libraries, files and packs read back."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from linegauge.llm import bpe, packing, token_files, tokens
from linegauge.session import scratch_dir
from odd_rows import nothing, odd  # noqa: F401

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = " \t\n\r    \u0085\x1c'stlmaéBc12!?漢😀\0.,"


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})


def fuzz(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_cut_texts_have_the_ids_of_the_whole_text(whole):
    texts = [*fuzz(4000), "end<|endoftext|> of", "a " * 500]
    made = tokens.Encoder(JSON).encode(texts)
    for text, ids in zip(texts, made):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_memory_bounds_change_nothing(whole, monkeypatch):
    monkeypatch.setattr(tokens, "CUTS_REMEMBERED", 3)
    monkeypatch.setattr(tokens, "WORDS_REMEMBERED", 3)
    encoder = tokens.Encoder(JSON)
    for text in fuzz(300):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_a_slice_is_encoded_at_once(whole):
    texts = [*fuzz(6000), None, "", "end<|endoftext|> of", "a " * 300, " ", "\n", "漢 字", "it's, 's 'll x's.y 12a,3", None]
    column = pa.array(["cut off", *texts, "cut off"]).slice(1, len(texts))
    for given in (column, column.cast(pa.large_string())):
        flat, counts = tokens.Encoder(JSON).ids_of(given)
        for text, ids in zip(texts, np.split(flat, np.cumsum(counts)[:-1])):
            assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert [x.tolist() for x in tokens.Encoder(JSON).ids_of(pa.array(["<|endoftext|>"]))] == [[50256], [1]]


def test_cuts_that_are_met_stay_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "CUTS_REMEMBERED", 3)
    encoder = tokens.Encoder(JSON)
    made, tokenized = [], encoder.tokenized
    monkeypatch.setattr(encoder, "tokenized", lambda word: made.append(word) or tokenized(word))
    for k in range(20):
        encoder.encode([f"the {'abcdefghijklmnopqrstuvwxyz'[k]}q"])
    assert made.count("the") == 1 and len(encoder.known_cuts) <= 3 and len(encoder.cuts_before) <= 3


@pytest.mark.parametrize("top", [200, 70_000])
def test_rows_of_ids_round_trip(top):
    rnd = np.random.default_rng(3)
    counts = rnd.integers(0, 9, 50)
    flat = rnd.integers(0, top, counts.sum()).astype("<u4")
    rows = pa.concat_arrays([pa.array([b"xy"]), tokens.packed_rows(flat, counts)]).slice(1)
    assert [tokens.unpacked(d, n).tolist() for d, n in zip(rows.to_pylist(), counts)] == [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert tokens.unpacked_rows(rows, counts).tolist() == flat.tolist()
    control, data = token_files.code_rows(flat, counts)
    each = [token_files.code(x) for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert list(zip(control.to_pylist(), data.to_pylist())) == each
    assert token_files.decode_rows(b"".join(control.to_pylist()), b"".join(data.to_pylist()), counts).tolist() == flat.tolist()


def test_short_and_long_words_are_merged_alike(tik):
    rank_of, dealt = bpe.ranks(RANKS), random.Random(4)
    made = ["".join(dealt.choice("aeinorst012é漢!") for _ in range(n)) for n in (*range(1, 130), 64, 65) for _ in range(4)]
    for word in [*made, "a" * 64, "ab" * 33, "ééé", "\0"]:
        raw = word.encode()
        expected = tik._encode_single_piece(raw)
        assert bpe.short_word_ids(raw, rank_of) == bpe.word_ids(raw, rank_of) == expected
        assert raw in rank_of or bpe.long_word_ids(raw, rank_of) == expected


def test_word_ids_match_the_library(tik):
    for text in [*fuzz(3000), "a" * 5000, "abcé" * 900]:
        made = [i for cut in tokens.cuts(text) for w in tokens.words(cut) for i in bpe.word_ids(w.encode(), bpe.ranks(RANKS))]
        assert made == tik.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("top", [1, 200, 255, 256, 70_000, (1 << 24) + 5, (1 << 32) - 1])
@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_variable_length_coding_round_trip(top, n):
    values = np.random.default_rng(n).integers(0, top + 1, n).astype("<u4")
    control, data = token_files.code(values)
    assert len(control) == -(-n // 4)
    assert token_files.decode(control, data, n).tolist() == values.tolist()


def test_files_give_all_ids_back_in_order(spark, odd, whole):
    folder = scratch_dir(spark, "test-token-files")
    token_files.write_corpus(odd, folder, JSON, end_id=2)
    rows = token_files.read_corpus(spark, folder).collect()
    expected = sorted(
        ((-1 if r.doc_id is None else r.doc_id, whole.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in odd.collect()),
        key=lambda x: x[0],
    )
    rows = sorted(rows, key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in rows] == [d for d, _ in expected]
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == sorted(ids for _, ids in expected)
    start = 0
    for r in rows:
        assert r.start == start and len(r.ids) == 4 * r.n_tokens
        start += r.n_tokens
    uses = [r.uses for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    assert uses == sorted(uses, reverse=True) and sum(uses) == start


def test_bpe_of_a_table_and_back(odd, tik):
    rows = bpe.decode(bpe.encode(odd, RANKS), RANKS).collect()
    made = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in rows)
    expected = []
    for r in odd.collect():
        ids = np.array(tik.encode_ordinary(r.text or ""), "<u4")
        expected.append((str(r.doc_id), len(ids), ids.tobytes(), (r.text or "").encode()))
    assert made == sorted(expected)


def test_packs_hold_each_id_once(odd, whole):
    made = packing.pack(tokens.encoded(odd, JSON, 1), full=64)
    pieces = made.pieces.collect()
    ids_of = {(r.task, r.row, r.start): tokens.unpacked(bytes(r.ids), r.length) for r in made.with_ids().collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.task, p.row].append(p)
        by_sequence[p.sequence_id].append(p)
        assert zlib.crc32(ids_of[p.task, p.row, p.start].tobytes()) == p.ids_crc32
    texts = sorted((str(r.doc_id), whole.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in odd.collect())
    found = []
    for key, parts in by_doc.items():
        parts.sort(key=lambda p: p.start)
        ids = np.concatenate([ids_of[(*key, p.start)] for p in parts]).tolist()
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        assert {p.doc_tokens for p in parts} == {len(ids)}
        found.append((str(parts[0].doc_id), ids))
    assert sorted(found) == texts
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        assert sum(p.length for p in parts) <= 64
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s in made.sequences().collect():
        ids = np.frombuffer(s.ids, "<u4")
        assert len(ids) == (s.n_tokens if s.n_tokens & (s.n_tokens - 1) == 0 else 64)
        assert ids[: s.n_tokens].tolist() == [i for p in by_sequence[s.sequence_id] for i in ids_of[p.task, p.row, p.start].tolist()]


def test_packing_leaves_little_room():
    lengths = np.minimum(2048, np.random.default_rng(0).lognormal(6.3, 1.0, 20_000).astype(int) + 1)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    patterns = packing.packing_patterns(histogram, 2048)
    assert sum(c * sum(kind) for c, kind in patterns) == lengths.sum()
    assert lengths.sum() / (2048 * sum(c for c, _ in patterns)) > 0.995
    # A length that holds nearly all rows makes no more patterns.
    assert len(packing.packing_patterns({700: 10**9, 650: 10, 3: 5}, 2048)) < 10


def test_empty_tables(spark, nothing):
    assert bpe.encode(nothing, RANKS).count() == 0
    assert packing.pack(tokens.encoded(nothing, JSON, 1)).pieces.count() == 0
    folder = scratch_dir(spark, "test-token-files")
    token_files.write_corpus(nothing, folder, JSON, end_id=2)
    assert token_files.read_corpus(spark, folder).count() == 0


def test_digest_of_nothing(odd):
    row = bpe.encode(odd.where("doc_id = 0"), RANKS).first()
    assert row.n_tokens == 0 and hashlib.sha256(bytes(row.ids)).hexdigest() == hashlib.sha256(b"").hexdigest()
