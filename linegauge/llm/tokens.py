"""Token ids of whole texts by a published byte-level BPE vocabulary of the tokenizers library.

Before every single space that a non-space follows, the vocabulary's splitting pattern always begins a new word, and so it does at some other pairs
of neighbouring bytes (``PAIRS``). A slice of texts is cut there at once, by table look-ups over its bytes, without a Python object for each word. Arrow tells the
distinct cuts of a slice apart, each new one is split into the pattern's words, and the library's BPE model encodes each word.
Cuts that a worker has met lately are remembered with their ids. The ids are those of the library's whole encoder (tests compare them), several
times sooner. Where a byte pair does not decide, nothing is cut: a longer cut has the same ids. Texts with a special token of the vocabulary go
through the whole encoder.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from linegauge.llm.common import slices

#: Bytes of text that are cut at once.
ENCODED_BYTES = 4 << 20
#: Distinct cuts that a worker remembers, and words of cuts that have several, bounds of its memory only. So many new cuts replace those not met meanwhile.
CUTS_REMEMBERED = 200_000
WORDS_REMEMBERED = 100_000
_INSIDE_RUN = re.compile(r"\s (?:\s|\Z)")
_RUN = re.compile(r"\s\s|\A\s|\s\Z")
_WORDS = regex.compile(public_tokenizers.PATTERN)
_ENCODERS: dict[str, Encoder] = {}


def cuts(text: str) -> list[str]:
    """Pieces whose ids, one after the other, are the ids of the text."""
    if not text:
        return []
    if "\0" in text or _INSIDE_RUN.search(text):
        return [text]
    marked = text.replace(" ", "\0 ")
    if not _RUN.search(text):
        # A line break between two non-spaces is a word of its own.
        marked = marked.replace("\n", "\0\n\0")
    pieces = marked.split("\0")
    return pieces if pieces[0] else pieces[1:]


def words(cut: str) -> list[str]:
    """The matches of the pattern in a cut; letters, alone or before a full stop or comma, need no pattern."""
    if cut[1:].isalpha() and (cut[0] == " " or cut[0].isalpha()):
        return [cut]
    if cut[-1] in ".," and cut[1:-1].isalpha() and (cut[0] == " " or cut[0].isalpha()):
        return [cut[:-1], cut[-1]]
    return _WORDS.findall(cut)


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself where printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


#: Kinds of bytes: 0 any other, 1 ASCII letter, 2 ASCII digit, 3 ASCII sign, 4 apostrophe, 5 first byte of a character that is no white space, 6 space.
KIND = np.zeros(256, np.uint8)
KIND[33:127] = 3
KIND[[b for b in range(128) if chr(b).isalpha()]] = 1
KIND[[b for b in range(128) if chr(b).isdigit()]] = 2
KIND[ord("'")] = 4
KIND[[b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3)]] = 5
KIND[ord(" ")] = 6
#: At 8 times the kind of a byte plus that of the next: 1 if a word begins at the second byte, 2 if one begins at the first (a space before a non-space).
#: An apostrophe may go on with letters, and a sign with other signs.
PAIRS = np.zeros(64, np.uint8)
PAIRS[[8 * a + b for a, b in ((1, 2), (1, 3), (1, 4), (2, 1), (2, 3), (2, 4), (3, 1), (3, 2))]] = 1
PAIRS[[8 * 6 + b for b in (1, 2, 3, 4, 5)]] = 2


def cut_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where cuts begin in the bytes of texts that follow each other; ``ends`` are those of the texts, 0 first. No cut lies in two texts."""
    kind = KIND[data]
    found = PAIRS[kind[:-1] * np.uint8(8) + kind[1:]]
    begins = np.zeros(len(data) + 1, bool)
    begins[:-2] = found == 2
    # What follows the last byte of a text is another text.
    begins[ends[ends > 0] - 1] = False
    begins[1:-1] |= found == 1
    # A line break between two ASCII non-spaces is a word of its own.
    line = np.flatnonzero(data == 10)
    line = line[(line > 0) & (line < len(data) - 1)]
    sure = np.isin(KIND, (1, 2, 3, 4))
    line = line[sure[data[line - 1]] & sure[data[line + 1]]]
    begins[line] = begins[line + 1] = True
    begins[ends] = True
    begins[0] = True
    return np.flatnonzero(begins[:-1])


class Encoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes_of = [i.to_bytes(4, "little") for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.known_cuts: dict[str, bytes] = {}
        self.cuts_before: dict[str, bytes] = {}

    def tokenized(self, word: str) -> bytes:
        bytes_of = self.bytes_of
        return b"".join([bytes_of[token.id] for token in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))])

    def word(self, word: str) -> bytes:
        if word not in self.known:
            if len(self.known) >= WORDS_REMEMBERED:
                self.known = {}
            self.known[word] = self.tokenized(word)
        return self.known[word]

    def cut(self, cut: str) -> bytes:
        """Ids of a cut that is not in ``known_cuts``, which has it from now on."""
        if (ids := self.cuts_before.get(cut)) is None:
            found = words(cut)
            ids = self.tokenized(cut) if len(found) == 1 else b"".join(map(self.word, found))
        if len(self.known_cuts) >= CUTS_REMEMBERED:
            self.cuts_before, self.known_cuts = self.known_cuts, {}
        self.known_cuts[cut] = ids
        return ids

    def ids_of_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``ids_of`` for texts without nulls and special tokens."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_string(texts.type) else np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        ends = offsets - offsets[0]
        if not ends[-1]:
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        starts = cut_starts(data, ends)
        places = pa.py_buffer(np.append(starts, len(data)))
        found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, places, pa.py_buffer(data)]).dictionary_encode()
        made = [ids if (ids := self.known_cuts.get(c)) is not None else self.cut(c) for c in found.dictionary.to_pylist()]
        taken = pa.array(made, pa.large_binary()).take(found.indices)
        at = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] // 4
        return np.frombuffer(taken.buffers()[2], "<u4")[: at[-1]], np.diff(at[np.searchsorted(starts, ends)])

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and the number of ids of each."""
        texts = pc.fill_null(texts, "")
        special = np.zeros(len(texts), bool)
        for token in self.special:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not special.any():
            return self.ids_of_plain(texts)
        flat, counts = self.ids_of_plain(texts.filter(pa.array(~special)))
        counted = np.zeros(len(texts), np.int64)
        counted[~special] = counts
        parts = iter(np.split(flat, np.cumsum(counts)[:-1]))
        made = []
        for k, whole in enumerate(special.tolist()):
            ids = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, "<u4") if whole else next(parts)
            counted[k] = len(ids)
            made.append(ids)
        return np.concatenate(made), counted

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        flat, counts = self.ids_of(pa.array(texts, pa.string()))
        return [ids.tobytes() for ids in np.split(flat, np.cumsum(counts)[:-1])] if texts else []


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def packed(ids: np.ndarray) -> bytes:
    """Two bytes an id where all fit, else four; ``unpacked`` tells by the number of ids."""
    return ids.astype("<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")


def packed_rows(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``packed`` for each of the rows that follow each other in ``flat``."""
    ends = np.append(0, np.cumsum(counts))
    if len(flat) and flat.max() >= 1 << 16:
        return pa.array([packed(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())
    made = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(2 * ends), pa.py_buffer(flat.astype("<u2"))])
    return made.cast(pa.binary())


def unpacked_rows(rows: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The ids of all rows, one row after the other."""
    sizes = pc.binary_length(rows).to_numpy(zero_copy_only=False)
    if (sizes == 2 * counts).all():
        offsets = np.frombuffer(rows.buffers()[1], np.int32 if pa.types.is_binary(rows.type) else np.int64)[rows.offset :]
        return np.frombuffer(rows.buffers()[2], np.uint8)[offsets[0] : offsets[len(rows)]].view("<u2").astype("<u4") if sizes.sum() else np.zeros(0, "<u4")
    return np.concatenate([np.zeros(0, "<u4"), *(unpacked(d, n) for d, n in zip(rows.to_pylist(), counts.tolist()))])


def encoded_batches(batches: Iterable[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """``doc_id, n_tokens, ids`` of batches with ``doc_id, text``, for use in tasks."""
    for part in slices(batches, limit=ENCODED_BYTES):
        flat, counts = encoder(path).ids_of(part.column("text"))
        flat = np.insert(flat, np.cumsum(counts), end_id)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts + 1), packed_rows(flat, counts + 1)], ["doc_id", "n_tokens", "ids"])


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every whole text, ``end_id`` appended. A null text counts as empty. Other columns are left out."""
    return docs.select("doc_id", "text").mapInArrow(lambda batches: encoded_batches(batches, path, end_id), "doc_id long, n_tokens long, ids binary")
