"""Where texts hold phrases of a benchmark: an FM-index of each shard of texts, searched backward.

A worker joins the words of a block of texts into shards, sorts each shard's suffixes and keeps the word before
each suffix as a wavelet matrix, whose ranks narrow a range of suffixes by one word at a time, all phrases at once.
Occurrences are located by walking back to the nearest sampled suffix position, and their spans merged.

Texts are worked on where they are read; nothing of them is shuffled. The phrases go to workers in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import by_size, free_name, text_of
from tierline.llm.suffix import first_keys, numbered, suffix_order, words_at_a_time

#: Words are runs of ASCII digits, letters (lower-cased) and everything past ASCII.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in range(48, 58) or c in range(97, 123) or c > 127 else 32 for c in range(256))
_ROWS_AT_A_TIME = 1 << 20


class Bits:
    """A bit for each place, with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(-(-(len(bits) + 1) // 64) * 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)]).astype(np.int32)
        self.ones = int(self.before[-1])

    def rank(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, place: np.ndarray) -> np.ndarray:
        return ((self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class Wavelet:
    """A wavelet matrix: one row of bits for each binary digit, the highest first."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.digits = list(range(max(1, largest.bit_length()) - 1, -1, -1))
        self.rows: list[Bits] = []
        self.zeros: list[int] = []
        for digit in self.digits:
            bits = ((symbols >> digit) & 1).astype(bool)
            self.rows.append(Bits(bits))
            self.zeros.append(len(bits) - self.rows[-1].ones)
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        # equal symbols end up side by side; where each begins
        last = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]])) if len(symbols) else np.zeros(0, np.int64)
        self.begin = np.zeros(largest + 1, np.int64)
        self.begin[symbols[last]] = last

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        for digit, row, zeros in zip(self.digits, self.rows, self.zeros):
            ones = row.rank(place)
            place = np.where((symbol >> digit) & 1, zeros + ones, place - ones)
        return place - self.begin[symbol]

    def get(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before it."""
        symbol = np.zeros(len(place), np.int64)
        for digit, row, zeros in zip(self.digits, self.rows, self.zeros):
            bit, ones = row.get(place), row.rank(place)
            symbol |= bit.astype(np.int64) << digit
            place = np.where(bit, zeros + ones, place - ones)
        return symbol, place - self.begin[symbol]


class FMIndex:
    """An index of texts given as word numbers, 1 and up, with a 0 after each text."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, largest: int, sample: int = 16):
        key, depth = first_keys(codes, starts, apart=False)
        order = suffix_order(key, depth)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=largest + 1))])
        self.wavelet = Wavelet(codes[order - 1], largest)
        # a text's first word is sampled too, so no walk leaves a text
        sampled = order % sample == 0
        first = np.zeros(len(codes), bool)
        first[starts] = True
        sampled |= first[order]
        self.sampled, self.places = Bits(sampled), order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase, a row of word numbers that ends in zeros if it is short."""
        low, high = np.zeros((2, len(phrases)), np.int64)
        begun = np.zeros(len(phrases), bool)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            word = phrases[live, column]
            new = live[(word > 0) & ~begun[live]]
            low[new], high[new] = self.before[phrases[new, column]], self.before[phrases[new, column] + 1]
            old = live[(word > 0) & begun[live]]
            begun[new] = True
            word = phrases[old, column]
            ranks = self.wavelet.rank(np.concatenate([word, word]), np.concatenate([low[old], high[old]]))
            low[old], high[old] = self.before[word] + ranks[: len(old)], self.before[word] + ranks[len(old) :]
            live = live[~begun[live] | (low[live] < high[live])]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows (none of them a text's end) begin."""
        out, rows, steps, open_ = np.empty(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(open_):
            there = self.sampled.get(rows)
            out[open_[there]] = self.places[self.sampled.rank(rows[there])] + steps
            rows, open_ = rows[~there], open_[~there]
            word, rank = self.wavelet.get(rows)
            rows, steps = self.before[word] + rank, steps + 1
        return out


@dataclass
class Phrases:
    """The distinct phrases of some items, as word numbers, and which items have them."""

    words: list[bytes]
    phrases: np.ndarray
    items: list[str | None]
    phrase: np.ndarray
    item: np.ndarray

    @cached_property
    def lengths(self) -> np.ndarray:
        return (self.phrases > 0).sum(1)

    @classmethod
    def of(cls, rows: list[tuple[str | None, str | None]], size: int) -> Phrases:
        known: dict[bytes, int] = {}
        found: dict[tuple[int, ...], int] = {}
        items: dict[str | None, int] = {}
        pairs: set[tuple[int, int]] = set()
        for item, text in rows:
            words = [known.setdefault(w, len(known)) for w in (text or "").encode().translate(_FOLD).split()]
            number = items.setdefault(item, len(items))
            for at in range(max(1, len(words) - size + 1) if words else 0):
                pairs.add((found.setdefault(tuple(words[at : at + size]), len(found)), number))
        phrases = np.full((len(found), size), -1, np.int64)
        for words, row in found.items():
            phrases[row, : len(words)] = words
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return cls(list(known), phrases + 1, list(items), both[:, 0], both[:, 1])


def _shards(codes: np.ndarray, starts: np.ndarray, most: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Shards of about ``most`` words: their words, where their texts begin, and where those stand in ``codes``.

    A text longer than that is cut into pieces, each with the first ``overlap`` words of the next.
    """
    pieces = []
    for start, end in zip(starts, np.append(starts[1:], len(codes)) - 1):
        pieces += [(at, min(at + most + overlap, end)) for at in range(start, max(end, start + 1), most)]
    group, size = [], 0
    for piece in [*pieces, None]:
        if group and (piece is None or size + piece[1] - piece[0] > most + overlap):
            parts = [np.append(codes[a:b], 0) for a, b in group]
            sizes = np.array([len(p) for p in parts])
            yield np.concatenate(parts), np.cumsum(sizes) - sizes, np.array([a for a, _ in group])
            group, size = [], 0
        if piece:
            group.append(piece)
            size += piece[1] - piece[0]


def hits(codes: np.ndarray, starts: np.ndarray, known: dict[bytes, int], wanted: Phrases, shard_words: int) -> tuple[np.ndarray, np.ndarray]:
    """How many phrases begin less how many end at each word, and the distinct pairs of text and item that occur."""
    change = np.zeros(len(codes) + 1, np.int64)
    pairs = [np.zeros(0, np.int64)]
    number = np.array([0, *(known.get(w, -1) for w in wanted.words)], np.int64)
    phrases = number[wanted.phrases]
    own = np.flatnonzero((phrases >= 0).all(1) & (wanted.lengths > 0))
    if not len(own):
        return change, pairs[0]
    phrases, lengths = phrases[own], wanted.lengths[own]
    first_item = np.searchsorted(wanted.phrase, own)
    item_count = np.searchsorted(wanted.phrase, own, "right") - first_item
    for words, begins, there in _shards(codes, starts, shard_words, phrases.shape[1] - 1):
        index = FMIndex(words, begins, len(known))
        low, high = index.search(phrases)
        hit = np.flatnonzero(low < high)
        counts = high[hit] - low[hit]
        ends = np.cumsum(counts)
        for at in range(0, int(ends[-1]) if len(ends) else 0, _ROWS_AT_A_TIME):
            slots = np.arange(at, min(at + _ROWS_AT_A_TIME, int(ends[-1])))
            which = np.searchsorted(ends, slots, "right")
            rows = low[hit[which]] + slots - (ends[which] - counts[which])
            places = index.locate(rows)
            text = np.searchsorted(begins, places, "right") - 1
            places = there[text] + places - begins[text]
            np.add.at(change, places, 1)
            np.add.at(change, places + lengths[hit[which]], -1)
            text = np.searchsorted(starts, places, "right") - 1
            both = np.unique(text * len(own) + hit[which])
            text, phrase = both // len(own), both % len(own)
            count = item_count[phrase]
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            items = wanted.item[np.repeat(first_item[phrase], count) + inner]
            pairs.append(np.unique(np.repeat(text, count) * len(wanted.items) + items))
    return change, np.unique(np.concatenate(pairs))


_SPANS = "array<struct<start: bigint, end: bigint>>"
_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_phrases(
    docs: DataFrame, items: DataFrame, column: str = "text", size: int = 10, names: tuple[str, str, str] = ("n_words", "spans", "items"),
    shard_bytes: int = 1 << 23, shard_words: int = 1 << 21, item_bytes: int = 1 << 26,
) -> DataFrame:
    """``docs`` with each row's number of words, the spans of words to remove, and the ids of the items found.

    A phrase is ``size`` words of an item (item_id, text) in a row, or all of an item of fewer. Spans are of word
    numbers from 0, the end not included; they are merged, in order, and apart from each other. Items are distinct,
    in no order, as text; those without an id give spans and no item. Null and empty texts have no words; an item
    without words is never found; items that repeat count once. Repeated rows get an answer each. Columns of
    ``docs`` stay as they are; taken names are refused.

    ``shard_bytes`` of text are indexed at a time, and longer texts in pieces of ``shard_words``. Items are sent to workers
    ``item_bytes`` of text at a time, and every such block is searched in all texts.
    """
    spark, (n_words, spans, found) = docs.sparkSession, names
    if len({c.lower() for c in [*docs.columns, *names]}) < len(docs.columns) + 3:
        raise ValueError(f"{names} must not be columns of the rows already")
    text, kept = free_name(docs, "whole_text"), docs.columns
    wanted = items.select(F.col("item_id").cast("string").alias("id"), text_of("text").alias("text"))
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / item_bytes))
    rows = docs.withColumns({
        text: text_of(column), n_words: F.lit(0).cast("long"), spans: F.array().cast(_SPANS), found: F.array().cast("array<string>"),
    })
    for number in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number) if blocks > 1 else wanted
        phrases = spark.sparkContext.broadcast(Phrases.of([(r.id, r.text) for r in part.collect()], size))

        def run(batches, phrases=phrases):
            for block in by_size(batches, text, shard_bytes):
                columns = [block.column(c) for c in [*kept, text]]
                yield pa.RecordBatch.from_arrays(columns + _searched(block, text, names, phrases.value, shard_words), names=[*kept, text, *names])

        rows = rows.mapInArrow(run, rows.schema)
    return rows.drop(text)


def _searched(block: pa.RecordBatch, text: str, names: tuple[str, str, str], wanted: Phrases, shard_words: int) -> list[pa.Array]:
    """A block's numbers of words, spans and items, those found before among them."""
    texts = block.column(text).cast(pa.binary())
    codes, starts, known = numbered(words_at_a_time((t.as_py() or b"").translate(_FOLD)) for t in texts)
    sizes = np.diff(np.append(starts, len(codes))) - 1
    change, pairs = hits(codes, starts, known, wanted, shard_words)
    before = block.column(names[1])
    if len(before.flatten()):
        spans, begin = before.flatten(), np.repeat(starts, np.diff(before.offsets.to_numpy()))
        np.add.at(change, begin + spans.field("start").to_numpy(), 1)
        np.add.at(change, begin + spans.field("end").to_numpy(), -1)
    covered = np.concatenate([[False], np.cumsum(change) > 0, [False]])
    edge = np.flatnonzero(covered[1:] != covered[:-1])
    first, end = edge[::2], edge[1::2]
    owner = np.searchsorted(starts, first, "right") - 1
    values = pa.StructArray.from_arrays([pa.array(first - starts[owner]), pa.array(end - starts[owner])], fields=list(_SPANS_ARROW.value_type))
    offsets = np.searchsorted(owner, np.arange(len(starts) + 1)).astype(np.int32)
    out_spans = pa.ListArray.from_arrays(pa.array(offsets), values)
    doc, item = np.divmod(pairs, max(1, len(wanted.items)))
    lists = block.column(names[2]).to_pylist()
    for row, number in zip(doc.tolist(), item.tolist()):
        if wanted.items[number] is not None:
            lists[row].append(wanted.items[number])
    return [pa.array(sizes, pa.int64()), out_spans, pa.array([sorted(set(x)) for x in lists], pa.list_(pa.string()))]


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Of each document how many of its words and which items are hit."""
    rows = find_phrases(docs.select("doc_id", "text"), items)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
