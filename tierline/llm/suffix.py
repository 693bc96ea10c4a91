"""Suffix order of many texts at once, by doubling the length that suffixes are compared by.

Texts are word numbers, 1 and up, joined into one array with a 0 after each. A suffix ends with its text's 0,
and zeros are told apart by their text, so no comparison runs from one text into the next.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


def words_at_a_time(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text between ASCII white space, about ``size`` bytes of it at a time, none of them cut."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[start:end].split()
        start = end
    yield text[start:].split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def numbered(texts: Iterable[Iterable[list[bytes]]]) -> tuple[np.ndarray, np.ndarray, dict[bytes, int]]:
    """All texts' word numbers with a 0 after each, where each text begins, and the words' numbers.

    Numbers count up in the order in which words first occur.
    """
    known = _Numbers()
    parts, starts, at = [], [], 0
    for text in texts:
        starts.append(at)
        for words in text:
            numbers = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
            parts.append(numbers)
            at += len(numbers)
        parts.append(np.zeros(1, np.int32))
        at += 1
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array(starts, np.int64), known


def first_keys(codes: np.ndarray, starts: np.ndarray, apart: bool) -> tuple[np.ndarray, int]:
    """A number for each suffix that orders it by its first words, and by how many.

    With ``apart`` suffixes are ordered by their text first, so those of different texts never stand together.
    """
    ends = np.append(starts[1:], len(codes)) - 1
    number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    if apart:
        values = codes.astype(np.int64)
        spare = 63 - max(1, (len(starts) - 1).bit_length())
    else:  # zeros by their text, then words
        values = codes + np.int64(len(starts) - 1)
        values[ends] = np.arange(len(starts))
        spare = 63
    width = max(1, int(values.max()).bit_length())
    depth = max(1, min(4, spare // width, len(codes)))
    key = number << (depth * width) if apart else np.zeros(len(codes), np.int64)
    for step in range(depth):  # a text's 0 decides, so what comes after it makes no difference
        key[: len(codes) - step] |= values[step:] << ((depth - 1 - step) * width)
    return key, depth


def suffix_order(key: np.ndarray, depth: int, levels: list[tuple[int, np.ndarray]] | None = None) -> np.ndarray:
    """Where the suffixes begin, in order; ``key`` orders them by ``depth`` words, the last suffix by itself.

    A suffix's rank is the place of the first suffix it is not yet told from. ``levels`` takes the ranks by
    each length of comparison.
    """
    n = len(key)
    order = np.argsort(key)
    new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]]) if n else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[order] = head
    open_ = ~(new & np.append(new[1:], True)) if n else new
    slots = np.flatnonzero(open_)
    while True:
        if levels is not None:
            levels.append((depth, rank.copy()))
        if not len(slots):
            return order
        suffixes = order[slots]
        both = (rank[suffixes].astype(np.int64) << 32) | rank[suffixes + depth]
        sort = np.argsort(both)
        both, suffixes = both[sort], suffixes[sort]
        order[slots] = suffixes
        new = np.concatenate([[True], both[1:] != both[:-1]])
        head = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[suffixes] = head
        slots = slots[~(new & np.append(new[1:], True))]
        depth *= 2


def shared_length(levels: list[tuple[int, np.ndarray]], codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``a`` and ``b`` (of one text, all different) begin with in common."""
    a, b = a.copy(), b.copy()
    length = np.zeros(len(a), np.int64)
    for depth, rank in reversed(levels):
        same = np.flatnonzero(rank[a] == rank[b])
        a[same] += depth
        b[same] += depth
        length[same] += depth
    for _ in range(levels[0][0] - 1):
        same = np.flatnonzero(codes[a] == codes[b])
        a[same] += 1
        b[same] += 1
        length[same] += 1
    return length
