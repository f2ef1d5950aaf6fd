"""Phrases of byte strings, cut at rolling-hash triggers.

Every ``span``-byte window of a text has one trigger: the position inside it whose ``GRAM``-byte rolling hash is least (the first of equals). Windows
that follow each other share their trigger for a while, and the bytes of such a run of windows are a phrase. Equal windows have equal triggers at
equal distance, wherever they stand, so equal passages are cut alike; and as phrases overlap by ``span`` - 1 bytes, each window lies in exactly one
phrase.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GRAM = 16
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64)
_ODD = [np.uint64(int(x) | 1) for x in _RANDOM.integers(1 << 62, 1 << 63, 16)]
_LOW = np.uint64(0xFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= _ODD[-1]
    x ^= x >> np.uint64(32)
    return x


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """x moved left, its end filled with zeros; only windows that fit are used later."""
    return np.concatenate([x[by:], np.zeros(min(by, len(x)), x.dtype)])


@dataclass
class Hashes:
    """Hashes of byte strings from each position: ``gram`` of GRAM bytes, and powers of two for windows."""

    gram: np.ndarray
    largest: np.ndarray
    reach: int
    span: int

    def window(self, at: np.ndarray) -> np.ndarray:
        """Hash of the ``span`` bytes from each position of ``at``."""
        return _mixed(self.largest[at] * _ODD[-2] + self.largest[at + self.span - self.reach])


def hashes(data: np.ndarray, span: int) -> Hashes:
    level, reach, k = _BYTE[data], 1, 0
    gram = level
    while reach * 2 <= span:
        level = _mixed(level * _ODD[k] + _shifted(level, reach))
        reach, k = reach * 2, k + 1
        if reach == GRAM:
            gram = level
    return Hashes(gram, level, reach, span)


@dataclass
class Phrases:
    """``start``: first window; ``count``: windows; ``trigger``: place of the trigger; ``key`` and ``digest``: hashes of trigger and content."""

    start: np.ndarray
    count: np.ndarray
    trigger: np.ndarray
    key: np.ndarray
    digest: np.ndarray


def phrases(data: np.ndarray, ends: np.ndarray, span: int) -> tuple[Phrases, Hashes]:
    """Phrases of texts laid end to end in ``data``; ``ends`` has the end of each text. Texts shorter than ``span`` have none."""
    made = hashes(data, span)
    n = len(data)
    width = span - GRAM + 1
    # Hash above, position below: the minimum gives the trigger, and of equal hashes the first.
    least = (made.gram & ~_LOW) | np.arange(n, dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    if len(least) + reach - 1 >= width:
        rest = width - reach
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    valid = np.zeros(n + 1, np.int64)
    has = ends - starts >= span
    np.add.at(valid, starts[has], 1)
    np.add.at(valid, ends[has] - span + 1, -1)
    windows = np.flatnonzero(np.cumsum(valid)[:n] > 0)
    if not len(windows):
        none = np.zeros(0, np.int64)
        return Phrases(none, none, none, none.astype(np.uint64), none.astype(np.uint64)), made
    trigger = (least[windows] & _LOW).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (windows[1:] != windows[:-1] + 1)
    # A text that ends where the next begins: windows of two texts are never neighbours, since the last span - 1 bytes start none.
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(windows)))
    start, trigger = windows[first], trigger[first]
    ends_hash = made.window(start) * _ODD[-3] + made.window(start + count - 1)
    digest = _mixed(ends_hash + count.astype(np.uint64) * _ODD[-4] + (trigger - start).astype(np.uint64))
    return Phrases(start, count, trigger, _mixed(made.gram[trigger] + _ODD[-5]), digest), made
