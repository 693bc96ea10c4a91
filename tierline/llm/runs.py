"""Stretches of words that repeat with a period: maximal pairs in an LCP-interval tree, per text.

A worker orders the suffixes of a block of texts and builds each text's tree of LCP intervals bottom-up, from
intervals of at least ``_LEAST_SHARED`` words. A node holds where its words occur, each with the word to the
left of it as its class. Where two children meet, occurrences of different classes whose distance is at most a
third of the node's length are a maximal pair: the words differ to the left and to the right, so the pair *is*
a run of that period. Only neighbours are looked at: occurrences within a third of their own length that are
not neighbours have a shorter period between them, and its pair is met at the same or a deeper node.

Rows are worked on where they are read; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import by_size, free_name, text_of
from tierline.llm.suffix import first_keys, numbered, shared_length, suffix_order, words_at_a_time

#: A run has at least six words and four periods: a pair at distance q shares at least max(6 - q, 3 * q) words.
LEAST_LENGTH, LEAST_PERIODS = 6, 4
_LEAST_SHARED = 5
_PLAIN = 1024


class Ordered:
    """Numbers in order, in blocks, so that one more costs little however many there are."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, numbers: list[int]):
        self.blocks = [numbers[i : i + _PLAIN // 2] for i in range(0, len(numbers), _PLAIN // 2)]
        self.firsts, self.size = [b[0] for b in self.blocks], len(numbers)

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def beside(self, number: int) -> tuple[int | None, int | None]:
        """The next smaller and the next larger number."""
        at = max(0, bisect_left(self.firsts, number) - 1)
        block = self.blocks[at]
        place = bisect_left(block, number)
        before = block[place - 1] if place else None
        after = block[place] if place < len(block) else self.firsts[at + 1] if at + 1 < len(self.firsts) else None
        return before, after

    def add(self, number: int) -> None:
        at = max(0, bisect_left(self.firsts, number) - 1)
        block = self.blocks[at]
        insort(block, number)
        self.size += 1
        self.firsts[at] = block[0]
        if len(block) > _PLAIN:
            half = block[_PLAIN // 2 :]
            del block[_PLAIN // 2 :]
            self.blocks.insert(at + 1, half)
            self.firsts.insert(at + 1, half[0])


def _joined(a: list[int] | Ordered, b: list[int] | Ordered, length: int, left: list[int], found: dict[tuple[int, int], int]):
    """Two children's occurrences in order; a run of each maximal pair between them goes to ``found``."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    reach = length // (LEAST_PERIODS - 1)
    plain = isinstance(large, list)
    for number in small:
        if plain:
            place = bisect_left(large, number)
            before = large[place - 1] if place else None
            after = large[place] if place < len(large) else None
        else:
            before, after = large.beside(number)
        for first, second in ((before, number), (number, after)):
            if first is None or second is None:
                continue
            period = second - first
            if period <= reach and left[first] != left[second] and period + length >= LEAST_LENGTH:
                run = (first, period + length)
                if period < found.get(run, period + 1):
                    found[run] = period
    if plain and len(large) + len(small) > _PLAIN:
        large = Ordered(large)
        plain = False
    if plain:
        large.extend(small)
        large.sort()
    else:
        for number in small:
            large.add(number)
    return large


def runs_of_block(codes: np.ndarray, starts: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of each text's runs, by start and then period; positions count from its first word."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in starts]
    if not len(codes):
        return out
    key, depth = first_keys(codes, starts, apart=True)
    levels: list[tuple[int, np.ndarray]] = []
    order = suffix_order(key, depth, levels)
    text = np.searchsorted(starts, order, "right")
    near = np.flatnonzero(text[1:] == text[:-1])
    if depth <= _LEAST_SHARED:  # those that differ in their first words need no closer look
        rank = levels[0][1]
        near = near[rank[order[near]] == rank[order[near + 1]]]
    shared = np.zeros(len(order) + 1, np.int64)
    shared[near + 1] = shared_length(levels, codes, order[near], order[near + 1])
    levels.clear()
    deep = shared >= _LEAST_SHARED
    # a tree's suffixes: those with a deep boundary on either side; shallow boundaries separate trees
    members = np.flatnonzero(deep[:-1] | deep[1:])
    if not len(members):
        return out
    places = order[members].tolist()
    lengths = np.where(deep, shared, 0)[members + 1].tolist()
    left_words = codes[np.maximum(order[members] - 1, 0)].astype(np.int64)
    begins = np.isin(order[members], starts)
    left_words[begins] = 0
    left = dict(zip(places, left_words.tolist()))
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, list[int] | Ordered]] = []
    for place, length in zip(places, lengths):
        node: list[int] | Ordered = [place]
        while stack and stack[-1][0] > length:
            above, held = stack.pop()
            node = _joined(held, node, above, left, found)
        if not length:
            continue
        if stack and stack[-1][0] == length:
            stack[-1] = (length, _joined(stack[-1][1], node, length, left, found))
        else:
            stack.append((length, node))
    for (first, length), period in sorted(found.items(), key=lambda run: (run[0][0], run[1])):
        number = int(np.searchsorted(starts, first, "right")) - 1
        out[number].append((first - int(starts[number]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [w for w, keep in zip(words, kept.tolist()) if keep]


_FOUND = "array<struct<start: bigint, length: bigint, period: bigint>>"


def find_runs(docs: DataFrame, column: str = "text", into: str = "runs", block_bytes: int = 1 << 22, without: str | None = None) -> DataFrame:
    """``docs`` with the runs of each row's whole text, and with the text without its repetitions if ``without`` names a column.

    Words stand between ASCII white space; a run is a longest stretch of at least six words and four periods in
    which words one (smallest) period apart are the same. Every row gets its own answer, repeated rows and
    null ids included; null and empty texts have no runs and nothing left. Columns of ``docs`` stay as they are; taken
    names are refused. ``block_bytes`` of text are worked on at a time, a longer text by itself.
    """
    added = [into] + ([without] if without else [])
    if len({c.lower() for c in [*docs.columns, *added]}) < len(docs.columns) + len(added):
        raise ValueError(f"{added} must not be columns of the rows already")
    text = free_name(docs, "whole_text")
    kept = docs.columns

    def run(batches):
        for block in by_size(batches, text, block_bytes):
            texts = [t or b"" for t in block.column(text).cast(pa.binary()).to_pylist()]
            codes, starts, known = numbered(words_at_a_time(t) for t in texts)
            found = runs_of_block(codes, starts)
            columns = [block.column(c) for c in kept]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            columns.append(pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], kind))
            if without:
                left = [b" ".join(collapsed(t.split(), runs)) for t, runs in zip(texts, found)]
                columns.append(pa.array(left, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema), f"`{into}` {_FOUND}", *([f"`{without}` string"] if without else [])])
    return docs.withColumn(text, text_of(column)).mapInArrow(run, schema)


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text, that of ids whose crc32 ends in 0 continued from a word on by repeating what follows there."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(ws: Column) -> Column:
        n, g = F.size(ws).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        return F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.element_at(ws, (a + (i - a) % p + 1).cast("int"))))

    made = F.array_join(F.element_at(F.transform(F.array(words), repeated), 1), " ")
    return F.when(h % 10 == 0, made).otherwise(text)


def digest(docs: DataFrame) -> DataFrame:
    """Of each document's runs how many, the longest one, and digests of all runs and of the text without repetitions."""
    rows = docs.select("doc_id", with_planted_runs(F.col("doc_id"), text_of("text")).alias("text"))
    found = find_runs(rows, without="collapsed").withColumn("n_runs", F.size("runs").cast("long"))
    first = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r.length).alias("shorter"), r.start.alias("start"), r.period.alias("period")))), 1)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    return found.withColumn("best", F.when(F.col("n_runs") > 0, first)).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.shorter")).alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * -best.shorter div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
