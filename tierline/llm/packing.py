"""Documents packed into token windows by the sum-of-squares rule.

Each input split is packed on its own and nothing is shuffled. A window's fill level is its number of
tokens. A document's whole windows are cut off first; the rest goes into the open window, or a new one,
for which the sum of the squared counts of windows per level grows least. Levels that need no padding,
powers of two and the full window, count nothing. When a split ends, or holds ``most_open`` open windows,
what is in windows that would be padded is cut anew into full ones.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import by_size, text_of

#: The split that the byte-level pre-tokenizer makes before merging; a fixed value of that format.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose class might differ between two libraries' Unicode tables.
_UNSURE = re.compile("[\x1c-\x1f\u0300-\U0010ffff]")
#: A place where any text can be cut: one space between characters that are not white space.
_SPACE = re.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def ranked(path: str):
    """The tokenizer file's merges as an encoder by rank, which gives the same ids at a fraction of the time.

    ``None`` unless the file is byte-level BPE without a normalizer whose merges, in order, make the ids
    after the 256 bytes: only then is merging the pair with the smallest id the same as the pair with
    the first merge.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model, splitter = parts["model"], parts["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or parts["normalizer"] or (splitter.get("type"), splitter.get("use_regex"), splitter.get("add_prefix_space")) != ("ByteLevel", True, False):
        return None
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if len(model["vocab"]) != 256 + len(merged) or any(model["vocab"].get(m) != 256 + i for i, m in enumerate(merged)):
        return None
    symbols = byte_symbols()
    ranks = {bytes(symbols[c] for c in token): number for token, number in model["vocab"].items()}
    return tiktoken.Encoding(path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, those that the tokenizer file's library gives."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = ranked(path)
        probe = "It's a  b\n\n c_d'll x2 -- é!'s\t"
        if self.fast and self.fast.encode_to_numpy(probe, disallowed_special=()).astype("<u4").tobytes() != self.whole(probe):
            self.fast = None

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not self.fast or any(s in text for s in self.special):
            return self.whole(text)
        return b"".join(map(self._stretch, stretches(text, 1 << 20)))

    def _stretch(self, text: str) -> bytes:
        if not text.isascii() and _UNSURE.search(text):
            return self.whole(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)


def stretches(text: str, most: int) -> Iterator[str]:
    """``text`` in stretches of about ``most`` characters, cut only before a space between words."""
    start = 0
    while len(text) - start > most and (found := _SPACE.search(text, start + most)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Packer:
    """Open windows of one split, by fill level.

    A piece is ``[document, start, ids]``; a finished window is a list of pieces.
    """

    def __init__(self, window: int, most_open: int):
        self.window, self.most_open, self.open = window, most_open, 0
        self.counts = np.zeros(window + 1, "int64")
        self.priced = np.array([h & (h - 1) != 0 and h < window for h in range(window + 1)])
        self.at: list[list[list]] = [[] for _ in range(window + 1)]

    def place(self, piece: list) -> list | None:
        """Put a piece of less than a window where the squares grow least; the window, if that filled it."""
        size = len(piece[2]) // 4
        squares = np.where(self.priced, 2 * self.counts + 1, 0)
        # what the new level adds, less what the old level gives back; the empty window gives nothing back
        growth = squares[size:].copy()
        growth[1:] -= np.where(self.priced, 2 * self.counts - 1, 0)[1 : self.window + 1 - size]
        usable = self.counts[: self.window + 1 - size] > 0
        usable[0] = True
        growth[~usable] = np.iinfo("int64").max
        level = len(growth) - 1 - int(np.argmin(growth[::-1]))  # of equals, the fullest
        pieces = [] if level == 0 else self.at[level].pop()
        if level:
            self.counts[level] -= 1
            self.open -= 1
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.at[level + size].append(pieces)
        self.counts[level + size] += 1
        self.open += 1
        return None

    def settle(self) -> Iterator[list]:
        """End all open windows: those that need no padding as they are, the others cut anew into full ones."""
        loose: list[list] = []
        for level in range(self.window, 0, -1):
            for pieces in self.at[level]:
                if self.priced[level]:
                    loose.extend(pieces)
                else:
                    yield pieces
            self.at[level] = []
        self.counts[:] = 0
        self.open = 0
        current, room = [], self.window
        for document, start, ids in loose:
            while ids:
                taken = ids[: 4 * room]
                current.append([document, start, taken])
                start, ids, room = start + len(taken) // 4, ids[len(taken) :], room - len(taken) // 4
                if room == 0:
                    yield current
                    current, room = [], self.window
        if current:
            yield current


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0,
    most_open: int = 4096,
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's tokens as little-endian unsigned 32-bit numbers. Every document ends with
    ``end_id``; a null or empty text is that id alone. Rows with a null or repeated id are documents of
    their own; other columns are left out, whatever their names; an empty table gives no rows. A
    sequence id holds the split's number and a number within it, so an attempt repeated over the same
    split gives the same sequences.
    """

    def run(batches):
        ids_of, packer, last = encoder(tokenizer_path), Packer(window, most_open), np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        kind = None

        def emit(pieces: list) -> None:
            nonlocal number
            offset = 0
            for (doc_id, tokens), start, ids in pieces:
                rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), tokens, number, offset, bytes(ids)))
                offset += len(ids) // 4
            number += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 8
            types = [kind, *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for block in by_size(batches, "text", 1 << 22):
            kind = block.column("id").type
            for doc_id, text in zip(block.column("id").to_pylist(), block.column("text").to_pylist()):
                ids = memoryview(ids_of.encode(text) + last)
                document = (doc_id, len(ids) // 4)
                whole = len(ids) // (4 * window) * window
                for start in range(0, whole, window):
                    emit([[document, start, ids[4 * start : 4 * (start + window)]]])
                if len(ids) > 4 * whole and (full := packer.place([document, whole, bytes(ids[4 * whole :])])):
                    emit(full)
                if packer.open > most_open:
                    for pieces in packer.settle():
                        emit(pieces)
                if len(rows) >= 2000:
                    yield batch()
                    rows.clear()
        for pieces in packer.settle():
            emit(pieces)
        if rows:
            yield batch()

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    pieces = picked.mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} long" for n in names[1:-1]) + ", ids binary")
    return pieces.withColumnRenamed("id", id_col)
