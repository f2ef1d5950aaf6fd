"""Quality rules by suffix-array repetition.

The words of a document are its symbols. Suffixes are sorted by prefix doubling (all documents of a slice at once: the first symbol of a suffix says
which document it is from, so no match crosses documents), and only suffixes that still tie are sorted again. Neighbours in the suffix array with
a common prefix of at least ``min_words`` bound the maximal repeated substrings; the union of their spans is the repeated part of the text.

A document is kept when it fails neither the base rules (number of words, words in repeated eight-word windows) nor the limits of
``RepetitionLimits``. Null text counts as empty, and an empty text fails the base rules. Null or repeated doc_ids get a row each. An empty table
gives no rows. Other columns are ignored by ``quality`` and passed on by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from linegauge.llm.common import documents, slices

SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
MIN_WORDS = 20
#: Per cent of the words that may lie in repeated windows.
WINDOW_LIMIT = 30


@dataclass(frozen=True)
class RepetitionLimits:
    """Repeated substrings count from ``min_words`` words. ``covered``: largest share of the characters of words that may lie in them.
    ``longest``: words that one repeat may have in any document; longer ones must stay within ``longest_share`` of the words."""

    min_words: int = 8
    covered: float = 0.30
    longest: int = 100
    longest_share: float = 0.15


COLUMNS = [
    ("doc_id", pa.int64()),
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()),
    ("covered_chars", pa.int64()),
    ("longest_repeat", pa.int64()),
    ("kept", pa.bool_()),
]
SCHEMA = ", ".join(f"{n} {'boolean' if t == pa.bool_() else 'long'}" for n, t in COLUMNS)


def _owners(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def suffix_repeats(symbols: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """For each position the length of the longest prefix of its suffix that occurs at another position too, 0 where it is below ``least``.

    ``symbols`` differ between documents; ``ends`` has the end of each position's document. A rank is the place in the suffix array at which
    the group of suffixes with an equal prefix begins, so groups are refined in place and ranks of settled suffixes stay.
    """
    n = len(symbols)
    longest = np.zeros(n, np.int64)
    order = np.argsort(symbols, kind="stable")
    active = np.arange(n)
    first = np.ones(n, bool)
    first[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, size = [], 1
    while True:
        # Only suffixes that still tie are sorted again.
        active = active[np.bincount(rank[active], minlength=n)[rank[active]] > 1]
        if not len(active):
            break
        levels.append((size, rank))
        after = active + size
        second = np.where(after < ends[active], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        at = np.arange(len(active))
        group = np.ones(len(active), bool)
        group[1:] = old[1:] != old[:-1]
        first = np.ones(len(active), bool)
        first[1:] = key[1:] != key[:-1]
        inside = np.maximum.accumulate(np.where(first, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[active] = old + inside
        size *= 2
    # Neighbours in the suffix array; their common prefix is found from the stored ranks, largest step first.
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    floor = max((level for level in levels if level[0] <= least), key=lambda level: level[0], default=None)
    if floor is None:
        return longest
    same = np.flatnonzero(floor[1][array[:-1]] == floor[1][array[1:]])
    left, right = array[same], array[same + 1]
    common = np.zeros(len(same), np.int64)
    for size, rank in reversed(levels):
        a, b = left + common, right + common
        fits = (a < ends[left]) & (b < ends[right])
        equal = fits & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        common += np.where(equal, size, 0)
    common[common < least] = 0
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """True for each of ``n`` positions within a span."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: codes of the words in order, their code points, and the number of words of each text."""
    lists = pc.split_pattern_regex(texts, SPACE + "+")
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    counts = np.bincount(_owners(np.diff(lists.offsets.to_numpy()))[real], minlength=len(texts))
    coded = words.filter(pa.array(real)).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    return codes, pc.utf8_length(coded.dictionary).to_numpy().astype(np.int64)[codes], counts


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    real = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    owner = _owners(np.diff(lists.offsets.to_numpy()))[real]
    coded = lines.filter(pa.array(real)).dictionary_encode()
    distinct = np.unique(owner * (len(coded.dictionary) + 1) + coded.indices.to_numpy()) // (len(coded.dictionary) + 1)
    return np.bincount(owner, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def measured(doc_ids: pa.Array, texts: pa.Array, limits: RepetitionLimits) -> pa.RecordBatch:
    texts = pc.fill_null(texts, "")
    docs = len(texts)
    codes, chars, counts = _words(texts)
    owner = _owners(counts)
    ends = np.cumsum(counts)[owner]
    least = min(WINDOW, limits.min_words)
    longest = suffix_repeats(owner * (codes.max(initial=0) + 1) + codes, ends, least)
    total = lambda values: np.bincount(owner, values, minlength=docs).astype(np.int64)
    windows = np.flatnonzero(longest >= WINDOW)
    repeated = total(covered(windows, np.full(len(windows), WINDOW), len(codes)))
    spans = np.flatnonzero(longest >= limits.min_words)
    in_spans = total(chars * covered(spans, longest[spans], len(codes)))
    most = np.zeros(docs, np.int64)
    np.maximum.at(most, owner[spans], longest[spans])
    word_chars = total(chars)
    failed = (counts < MIN_WORDS) | (100 * repeated > WINDOW_LIMIT * counts)
    good = (in_spans <= limits.covered * word_chars) & (most <= np.maximum(limits.longest, limits.longest_share * counts))
    symbols = pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy()
    values = [counts, word_chars, symbols, _duplicate_lines(texts), repeated, failed, in_spans, most, ~failed & good]
    return pa.RecordBatch.from_arrays([doc_ids, *(pa.array(v, t) for v, (_, t) in zip(values, COLUMNS[1:]))], [n for n, _ in COLUMNS])


def quality(docs: DataFrame, limits: RepetitionLimits = RepetitionLimits()) -> DataFrame:
    """A row for each document: base figures, ``base_failed``, ``covered_chars``, ``longest_repeat`` and ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield measured(part.column("doc_id"), part.column("text"), limits)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, limits: RepetitionLimits = RepetitionLimits()) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all columns, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield part.filter(measured(part.column("doc_id"), part.column("text"), limits).column("kept"))

    return docs.mapInArrow(run, docs.schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))
