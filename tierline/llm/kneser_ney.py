"""Perplexity by an interpolated modified Kneser-Ney model of word pairs, counted over all training text.

Tasks count the pairs of the texts they read. Counts go by the first word's hash to shards, those of very
frequent first words by both words' hash, so no word can fill a shard. A shard's task adds them up and
writes one file of sorted pair hashes with their counts. What it knows of single words (how often, after
how many words, before how many words that follow once, twice, more often) goes on to shards of words, which
are written the same way. Workers map the files into memory and look words and pairs up by binary search.

Words are told by 56-bit hashes and pairs by 64-bit ones.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import by_size, held_out, shared_dir, text_of
from tierline.llm.jaccard import mix, word_hashes

_WIDTH = 7
#: The start of a text, only ever a context, and its end, a token.
START, END = np.uint64(1), np.uint64(2)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens, an end after each text, and where each text's tokens begin and end."""
    words, edges = word_hashes(texts)
    edges = np.asarray(edges) + np.arange(len(edges))
    out = np.full(len(words) + len(texts), END)
    inside = np.ones(len(out), bool)
    inside[edges[1:] - 1] = False
    out[inside] = np.maximum(words >> np.uint64(64 - 8 * _WIDTH), END + np.uint64(1))
    return out, edges


def contexts(out: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The token before each token, the start for a text's first."""
    before = np.concatenate([[START], out[:-1]])
    before[edges[:-1]] = START
    return before


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) + second * _SECOND)


def _narrow(ids: np.ndarray) -> bytes:
    return ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_WIDTH].tobytes()


def _wide(data: bytes) -> np.ndarray:
    full = np.zeros((len(data) // _WIDTH, 8), np.uint8)
    full[:, :_WIDTH] = np.frombuffer(data, np.uint8).reshape(-1, _WIDTH)
    return full.view("<u8").ravel()


def _squeezed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def _loose(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<i8")


def _added(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return (keys, *counts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *(np.add.reduceat(c[order], first) for c in counts))


def _runs(numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and end of each run of equal numbers."""
    edges = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1], [True]])) if len(numbers) else []
    for start, end in zip(edges[:-1], edges[1:]):
        yield int(numbers[start]), start, end


def _write(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """One file of arrays after their sizes, complete or not there; a repeated attempt writes the same."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], "<i8")
    where = urlparse(folder)
    if where.scheme in ("", "file"):
        target = os.path.join(unquote(where.path), name)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        part = f"{target}.{uuid.uuid4().hex}"
        with open(part, "wb") as file:
            for array in (head, *arrays):
                array.tofile(file)
        os.replace(part, target)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    part = f"{path}/{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as file:
        for array in (head, *arrays):
            file.write(array.tobytes())
    store.move(part, f"{path}/{name}")


def _mapped(folder: str, name: str, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory; from a store that is not mounted, by way of a file that is removed at once."""
    where = urlparse(folder)
    if where.scheme in ("", "file"):
        raw = np.memmap(os.path.join(unquote(where.path), name), np.uint8, "r")
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(f"{path}/{name}") as file:
            while data := file.read(1 << 22):
                copy.write(data)
            copy.flush()
            raw = np.memmap(copy.name, np.uint8, "r")
    sizes = raw[8 : 8 + 8 * int(raw[:8].view("<i8")[0])].view("<i8")
    at, arrays = 8 + 8 * len(sizes), []
    for size, kind in zip(sizes.tolist(), kinds):
        end = at + size * np.dtype(kind).itemsize
        arrays.append(raw[at:end].view(kind))
        at = end
    return arrays


_PAIR_KINDS = ("<u8", "<i8", "<i8", "u1")
_WORD_KINDS = ("<u8", "<i8", "<u4", "<u4", "<u4", "<u4")


def discounts(counts: list[int]) -> np.ndarray:
    """What is taken from counts 0, 1, 2 and 3 or more, by how many have count 1, 2, 3 and 4."""
    n = [max(0, c) for c in counts]
    share = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    taken = [0.0]
    for i in (1, 2, 3):
        value = i - (i + 1) * share * n[i] / n[i - 1] if n[i - 1] and n[i] else share
        taken.append(min(max(value, 0.05), i - 0.05))
    return np.array(taken)


@dataclass
class Model:
    """Where a model's files are, and its few numbers."""

    folder: str
    shards: int
    spread: np.ndarray
    names: frozenset[str]
    tokens: int
    words: int
    texts: int
    pairs: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    word_kept: float

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "files"}

    @cached_property
    def files(self) -> dict[str, list[np.ndarray]]:
        return {}

    def _file(self, name: str, kinds: tuple[str, ...]) -> list[np.ndarray]:
        if name not in self.files:
            self.files[name] = _mapped(self.folder, name, kinds)
        return self.files[name]

    def _find(self, kind: str, kinds: tuple[str, ...], shard: np.ndarray, keys: np.ndarray, columns: int) -> np.ndarray:
        """A row of the file's columns for each key, zero for those it does not have. Keys are sorted within a shard."""
        found = np.zeros((columns, len(keys)), np.int64)
        for number, start, end in _runs(shard):
            name = f"{kind}-{number}"
            if name not in self.names:
                continue
            arrays = self._file(name, kinds)
            known, own = arrays[0], keys[start:end]
            place = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = known[place] == own
            if kind == "words":
                for i in range(columns):
                    found[i, start:end] = np.where(hit, arrays[i + 1][place], 0)
            else:
                _, large, large_counts, small = arrays
                counts = small[place].astype(np.int64)
                over = np.flatnonzero(hit & (counts == 255))
                counts[over] = large_counts[np.searchsorted(large, place[over])]
                found[0, start:end] = np.where(hit, counts, 0)
        return found

    def look_up(self, ids: np.ndarray) -> np.ndarray:
        """Count, words that follow once, twice and more often, and words before, of each (distinct) word."""
        shard = (ids % np.uint64(self.shards)).astype(np.int64)
        order = np.lexsort((ids, shard))
        out = np.empty((5, len(ids)), np.int64)
        out[:, order] = self._find("words", _WORD_KINDS, shard[order], ids[order], 5)
        return out

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = pair_hash(first, second)
        shard = shard_of(first, key, self.shards, self.spread)
        order = np.lexsort((key, shard))
        out = np.empty(len(key), np.int64)
        out[order] = self._find("pairs", _PAIR_KINDS, shard[order], key[order], 1)[0]
        return out

    def score(self, out: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token its training count, and log10 of its probability after the token before it."""
        ids, place = np.unique(np.concatenate([out, before]), return_inverse=True)
        count, once, twice, more, preceding = self.look_up(ids)
        after, context = place[: len(out)], place[len(out) :]
        total = np.where(ids == START, self.texts, np.where(ids == END, 0, count))
        if not self.tokens:
            return count[after], np.full(len(out), -math.log10(self.words + 1))
        kept = np.maximum(preceding - self.word_discounts[np.minimum(preceding, 3)], 0) / self.pairs
        single = kept + self.word_kept / (self.words + 1)
        taken = self.pair_discounts
        left = np.where(total > 0, (taken[1] * once + taken[2] * twice + taken[3] * more) / np.maximum(total, 1), 1.0)
        pairs = self.pair_counts(before, out)
        own = np.maximum(pairs - taken[np.minimum(pairs, 3)], 0) / np.maximum(total, 1)[context]
        return count[after], np.log10(own + left[context] * single[after])


def shard_of(first: np.ndarray, key: np.ndarray, shards: int, spread: np.ndarray) -> np.ndarray:
    """By the first word, or the pair where the first word is one of those to spread."""
    return (np.where(np.isin(first, spread), key, first) % np.uint64(shards)).astype(np.int64)


def _texts(block: pa.RecordBatch) -> list[bytes]:
    return block.column("text").cast(pa.binary()).to_pylist()


def words_to_spread(rows: DataFrame, sample_rows: int, share: float) -> np.ndarray:
    """Words that make ``share`` of the tokens in about ``sample_rows`` rows picked by hash: at most 1 / ``share``.

    They only decide which shard counts a pair.
    """
    part = min(1.0, sample_rows / max(1, rows.count()))

    def run(batches):
        for block in by_size(batches, "text", 1 << 20):
            values, counts = np.unique(tokens(_texts(block))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts, pa.int64())], ["word", "n"])

    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(part * (1 << 20))).select("text")
    counted = sample.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("n") >= max(1.0, share * total)).select("word").toArrow().column(0).to_numpy()
    return np.sort(found.astype(np.uint64))


_PAIR_ROWS = "shard int, first binary, sizes binary, second binary, counts binary"
_WORD_ROWS = "shard int, words binary, facts binary"


def train(texts: DataFrame, folder: str, shard_bytes: int = 1 << 23, buffer: int = 1 << 20, sample_rows: int = 4096) -> Model:
    """Count the rows of ``texts`` (text) and write the model's files to ``folder``, shared with all workers.

    Shards are as many as there are ``shard_bytes`` of text, so their size does not depend on the input's;
    ``buffer`` is the number of tokens that a task counts at a time.
    """
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    spread = words_to_spread(texts, sample_rows, 1 / 256)

    def count(batches):
        firsts: list[np.ndarray] = []
        seconds: list[np.ndarray] = []

        def flush():
            first, second = np.concatenate(firsts), np.concatenate(seconds)
            firsts.clear()
            seconds.clear()
            key = pair_hash(first, second)
            order = np.argsort(key, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
            counts = np.diff(np.append(start, len(key)))
            own = order[start]
            first, second, key = first[own], second[own], key[own]
            shard = shard_of(first, key, shards, spread)
            order = np.lexsort((first, shard))
            first, second, counts, shard = first[order], second[order], counts[order], shard[order]
            for number, begin, end in _runs(shard):
                group = np.flatnonzero(np.concatenate([[True], first[begin + 1 : end] != first[begin : end - 1]]))
                sizes = np.diff(np.append(group, end - begin))
                yield number, _narrow(first[begin:end][group]), _squeezed(sizes), _narrow(second[begin:end]), _squeezed(counts[begin:end])

        def batch(rows) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 4))], ["shard", "first", "sizes", "second", "counts"]
            )

        for block in by_size(batches, "text", 1 << 20):
            out, edges = tokens(_texts(block))
            firsts.append(contexts(out, edges))
            seconds.append(out)
            if sum(map(len, seconds)) >= buffer:
                yield batch(list(flush()))
        if seconds:
            yield batch(list(flush()))

    def add_pairs(key, group):
        number = key[0].as_py()
        parts = [group.column(c).to_pylist() for c in ("first", "sizes", "second", "counts")]
        first = np.concatenate([np.repeat(_wide(f), _loose(s)) for f, s in zip(parts[0], parts[1])])
        second = np.concatenate([_wide(s) for s in parts[2]])
        counts = np.concatenate([_loose(c) for c in parts[3]])
        key = pair_hash(first, second)
        order = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        counts, own = np.add.reduceat(counts[order], start), order[start]
        first, second, key = first[own], second[own], key[own]
        large = np.flatnonzero(counts >= 255)
        _write(folder, f"pairs-{number}", [key.astype("<u8"), large.astype("<i8"), counts[large].astype("<i8"), np.minimum(counts, 255).astype("u1")])
        zero, one = np.zeros(len(key), np.int64), np.ones(len(key), np.int64)
        facts = [
            np.concatenate([a, b])
            for a, b in ((counts, zero), (zero, counts == 1), (zero, counts == 2), (zero, counts > 2), (one, zero))
        ]
        words, *facts = _added(np.concatenate([second, first]), *[f.astype(np.int64) for f in facts])
        shard = (words % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        words, facts, shard = words[order], [f[order] for f in facts], shard[order]
        rows = [(s, _narrow(words[a:b]), _squeezed(np.concatenate([f[a:b] for f in facts]))) for s, a, b in _runs(shard)]
        rows.append((-1, b"", _squeezed(np.array([np.sum(counts == i) for i in (1, 2, 3, 4)] + [len(counts)]))))
        rows.append((-2 - number, b"", _squeezed(np.zeros(0))))  # that there is a file
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["shard", "words", "facts"])

    def add_words(key, group):
        number = key[0].as_py()
        facts = [_loose(f) for f in group.column("facts").to_pylist()]
        if number < -1:
            totals = np.zeros(0, np.int64)
        elif number < 0:
            totals = np.sum(facts, axis=0)
        else:
            words = [_wide(w) for w in group.column("words").to_pylist()]
            columns = [np.concatenate([f.reshape(5, -1)[i] for f in facts]) for i in range(5)]
            words, *columns = _added(np.concatenate(words), *columns)
            _write(folder, f"words-{number}", [words.astype("<u8"), columns[0].astype("<i8"), *(c.astype("<u4") for c in columns[1:])])
            tokens_, preceding = columns[0], columns[4]
            ends = tokens_[words == END].sum()
            totals = np.array([tokens_.sum(), (tokens_ > 0).sum(), ends, *[(preceding == i).sum() for i in (1, 2, 3, 4)], (preceding >= 3).sum()])
        return pa.Table.from_arrays([pa.array([number], pa.int32()), pa.array([totals.tolist()], pa.list_(pa.int64()))], ["shard", "totals"])

    pairs = texts.mapInArrow(count, _PAIR_ROWS).groupBy("shard").applyInArrow(add_pairs, _WORD_ROWS)
    summed = pairs.groupBy("shard").applyInArrow(add_words, "shard int, totals array<long>")
    # one short row for each shard, added up before it is collected, and the numbers of those that have files
    sums = [F.sum(F.get("totals", F.lit(i))).alias(f"t{i}") for i in range(8)]
    rows = summed.groupBy((F.col("shard") < 0).alias("of_pairs")).agg(F.collect_list("shard").alias("shards"), *sums).collect()
    of = {r.of_pairs: [x or 0 for x in r[2:]] for r in rows}
    of_pairs, of_words = of.get(True, [0] * 8), of.get(False, [0] * 8)
    numbers = [n for r in rows for n in r.shards]
    files = {f"words-{n}" for n in numbers if n >= 0} | {f"pairs-{-2 - n}" for n in numbers if n < -1}
    taken = discounts(of_words[3:7])
    kept = float(taken[1] * of_words[3] + taken[2] * of_words[4] + taken[3] * of_words[7]) / max(1, of_pairs[4])
    return Model(folder, shards, spread, frozenset(files), of_words[0], of_words[1], of_words[2], of_pairs[4], discounts(of_pairs[:4]), taken, kept)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, n_known, base_score, score for every row; see ``perplexity``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        for block in by_size(batches, "text", 1 << 20):
            out, edges = tokens(_texts(block))
            count, logs = model.score(out, contexts(out, edges))
            base = np.log10((count + 1) / (model.tokens + model.words + 1))
            start = edges[:-1]
            columns = [np.diff(edges), np.add.reduceat((count > 0).astype(np.int64), start), np.add.reduceat(base, start), np.add.reduceat(logs, start)]
            yield pa.RecordBatch.from_arrays([block.column("id"), *map(pa.array, columns)], ["id", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    scored = rows.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumnRenamed("id", id_col)


def perplexity(docs: DataFrame, out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity for every document.

    The model learns from the rows that ``out`` does not hold for; by default a seventh, by the id's crc32,
    is held out. Scores are log10 of a text's probability, its end included. A null text is empty and
    scores its end alone; null and repeated ids are allowed; other columns are left out, whatever their
    names. An empty table gives no rows; with nothing to learn from every token is as likely as any other.
    """
    out = held_out(id_col, 7, 2) if out is None else out
    model = train(docs.where(~out).select(text_of(text_col).alias("text")), shared_dir(docs.sparkSession, "kneser-ney"))
    mark = "held_out"
    rows = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), out.alias(mark)).alias("id"), F.col(f"`{text_col}`").alias("text"))
    scored = score_texts(rows, model, "id", "text")
    return scored.select(
        F.col("id.id").alias(id_col), F.col(f"id.{mark}").alias(mark), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
