"""Phrases whose words stand together more than their parts do, per language.

Only the longest windows are counted: each word with the three after it in its piece of text, padded where the
piece ends. The counts of all shorter phrases are sums over windows that begin with them, which one ROLLUP makes.

A window is cut before a word that is too rare to be in any candidate; what tells such words is a bit set of fixed
size, made of the frequent words' hashes. Tasks count the windows they read, and the counts go to
partitions by the first two words, so that a partition knows how often each of its longer beginnings occurs
and cuts the rare ones before the ROLLUP. Words travel as 64-bit hashes; that no two words share one is
checked over all words, and otherwise other hashes are taken.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import by_size, cut, text_of

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAK = re.compile(rb"[.,;:!?\n\x0b\x0c\r]+")
_SPACE = re.compile(rb"[ \t]")
LONGEST = 4
KEY = ["w1", "w2", "w3", "w4"]
_BITS = 1 << 24
_SEGMENT = 1 << 20
_ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15], np.uint64)


def pieces(text: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """The words of a text, and whether a piece ends after them; a long piece comes in parts."""
    for piece in _BREAK.split(text.translate(_LOWER)):
        start = 0
        while len(piece) - start > _SEGMENT:
            found = _SPACE.search(piece, start + _SEGMENT)
            if not found:
                break
            yield piece[start : found.start()].split(), False
            start = found.end()
        yield piece[start:].split(), True


def word_counts(docs: DataFrame, buffer: int = 1 << 18) -> DataFrame:
    """How often each language (lang) has each word."""

    def run(batches):
        counts: dict[str, Counter[bytes]] = {}
        held = 0

        def flush():
            for lang, own in counts.items():
                words = pa.array(list(own), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), words, pa.array(list(own.values()), pa.int64())], ["lang", "word", "n"])

        for block in by_size(batches, "text", _SEGMENT):
            for lang, text in zip(block.column("lang").to_pylist(), block.column("text").cast(pa.binary()).to_pylist()):
                own = counts.setdefault(lang, Counter())
                held -= len(own)
                for words, _ in pieces(text):
                    own.update(words)
                held += len(own)
                if held > buffer:
                    yield from flush()
                    counts, held = {}, 0
        yield from flush()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hash(word: Column, salt: str) -> Column:
    return F.xxhash64(F.concat(F.lit(salt), word))


def _distinct_hashes(words: DataFrame) -> str:
    """What to put before words so that their hashes are all different, and none is 0."""
    for number in range(8):
        salt = str(number) if number else ""
        by_hash = words.groupBy(_hash(F.col("word"), salt).alias("h")).agg(F.min("word").alias("a"), F.max("word").alias("b"))
        if by_hash.where((F.col("a") != F.col("b")) | (F.col("h") == 0)).isEmpty():
            return salt
    raise RuntimeError("no seed of the hash tells all words apart")


def _bit_set(frequent: DataFrame) -> bytes:
    """A bit for the hash of each frequent word; of fixed size, whatever their number."""
    place = F.col("h").bitwiseAND(F.lit(_BITS - 1)) + 1
    chunks = frequent.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    size, out = 4096, bytearray(_BITS // 8)
    for row in chunks.collect():
        out[(row["at"] - 1) * size : row["at"] * size] = row["bits"]
    return bytes(out)


class _Numbers(dict):
    """Numbers of words in a buffer, 0 for those that are rare."""

    def __init__(self, salt: str, bits: bytes, hashes: list[int]):
        self.salt, self.bits, self.hashes = salt.encode(), bits, hashes

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(self.salt + word, 42)
        place, number = value & (_BITS - 1), 0
        if self.bits[place >> 3] >> (place & 7) & 1:
            self.hashes.append(value)
            number = len(self.hashes) - 1
        self[word] = number
        return number


def windows(docs: DataFrame, salt: str, bits: bytes, buffer: int = 1 << 20) -> DataFrame:
    """How often each window occurs in parts of the rows: lang, the words' hashes w1 to w4 (0: padding), n."""

    def counted(codes: np.ndarray, langs: list[tuple[int, str]], hashes: list[int], upto: int) -> Iterator[pa.RecordBatch]:
        """The windows that begin before ``upto``."""
        bits = max(1, (len(hashes) - 1).bit_length())
        first = codes[:upto]
        own = np.flatnonzero(first)
        columns = [codes[own].astype(np.int64)]
        for step in range(1, LONGEST):
            columns.append(np.where(columns[-1] > 0, codes[own + step], 0))
        marks, names = np.array([at for at, _ in langs]), [name for _, name in langs]
        known = {name: i for i, name in enumerate(dict.fromkeys(names))}
        lang = np.array([known[n] for n in names], np.int64)[np.searchsorted(marks, own, "right") - 1]
        high, low = (columns[0] << bits) | columns[1], (columns[2] << bits) | columns[3]
        # by the first two words, then by a hash of the rest; where that brings equal windows apart, both parts are counted
        spare = np.uint64(64 - 2 * bits)
        rest = low.astype(np.uint64) * _ODD[0] + lang.astype(np.uint64) * _ODD[1]
        order = np.argsort((high.astype(np.uint64) << spare) | (rest * _ODD[2] >> (np.uint64(64) - spare)))
        high, low, lang = high[order], low[order], lang[order]
        start = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (lang[1:] != lang[:-1])])) if len(own) else own
        value = np.array(hashes, np.uint64).view(np.int64)
        pick, counts = order[start], np.diff(np.append(start, len(own)))
        for at in range(0, len(pick), 1 << 16):
            part = slice(at, at + (1 << 16))
            names_of = pa.DictionaryArray.from_arrays(pa.array(lang[start[part]].astype(np.int32)), pa.array(list(known), pa.string())).cast(pa.string())
            hashed = [pa.array(value[c[pick[part]]]) for c in columns]
            yield pa.RecordBatch.from_arrays([names_of, *hashed, pa.array(counts[part])], ["lang", *KEY, "n"])

    def run(batches):
        codes: list[int] = []
        hashes = [0]
        numbers = _Numbers(salt, bits, hashes)
        langs: list[tuple[int, str]] = []
        for block in by_size(batches, "text", _SEGMENT):
            for lang, text in zip(block.column("lang").to_pylist(), block.column("text").cast(pa.binary()).to_pylist()):
                langs.append((len(codes), lang))
                for words, ends in pieces(text):
                    codes.extend(map(numbers.__getitem__, words))
                    if ends:
                        codes.append(0)
                    if len(codes) > buffer:  # the last words' windows may go on
                        rest, done = codes[1 - LONGEST :], np.array(codes, np.int32)
                        yield from counted(done, langs, hashes, len(done) - len(rest))
                        again = [hashes[c] for c in rest]
                        hashes = [0]
                        numbers = _Numbers(salt, bits, hashes)
                        codes = []
                        for value in again:
                            codes.append(len(hashes) if value else 0)
                            if value:
                                hashes.append(value)
                        base = bisect_right(langs, len(done) - len(rest), key=lambda mark: mark[0]) - 1
                        langs = [(max(0, at - len(done) + len(rest)), name) for at, name in langs[base:]]
        if codes:
            yield from counted(np.array(codes + [0] * LONGEST, np.int32), langs, hashes, len(codes))

    return docs.mapInArrow(run, "lang string, w1 long, w2 long, w3 long, w4 long, n long")


def _frequent_prefixes(docs: DataFrame, salt: str, bits: bytes, least: int, rows: int, share: float) -> list[DataFrame]:
    """Phrases of one to three words that begin ``share`` or more of the windows of about ``rows`` rows, and at least ``least``.

    There are at most 1 / ``share`` of each length. They decide where rows go and what needs no count, not what is found.
    """
    part = min(1.0, rows / max(1, docs.count()))
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(part * (1 << 20)))
    counted = cut(windows(sample, salt, bits).groupBy("lang", *KEY).agg(F.sum("n").alias("n")), "phrase-sample")
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = []
    for length in range(1, LONGEST):
        own = counted.where(F.col(KEY[length - 1]) != 0).groupBy("lang", *KEY[:length]).agg(F.sum("n").alias("n"))
        hot = own.where(F.col("n") >= max(least, share * total)).select("lang", *KEY[:length])
        found.append(docs.sparkSession.createDataFrame(hot.collect(), hot.schema))
    return found


def phrase_counts(docs: DataFrame, least: int = 30, salts: int = 64, sample_rows: int = 4096) -> tuple[DataFrame, DataFrame, str, list[DataFrame]]:
    """Counts of all phrases of one to four words that occur ``least`` times (words: cut where rarer), of all words, the salt
    of the words' hashes, and the phrases that begin very many windows."""
    words = cut(word_counts(docs), "phrase-words")
    salt = _distinct_hashes(words)
    frequent = words.where(F.col("n") >= least).select(_hash(F.col("word"), salt).alias("h"))
    bits = _bit_set(frequent)
    hot = _frequent_prefixes(docs, salt, bits, least, sample_rows, 1 / 256)
    rows = windows(docs, salt, bits)
    for length in (2, 3):
        rows = rows.join(F.broadcast(hot[length - 1].withColumn(f"hot{length}", F.lit(True))), ["lang", *KEY[:length]], "left")
    spread = F.when(F.col("hot3"), F.pmod(F.xxhash64("w4"), F.lit(salts)) + 1 + salts).when(F.col("hot2"), F.pmod(F.xxhash64("w3"), F.lit(salts)) + 1)
    # a salt says whether the first two or three words are hot: those of hot three are hot themselves
    rows = rows.select("lang", *KEY, "n", F.coalesce(spread, F.lit(0)).cast("int").alias("salt")).repartition("lang", "w1", "w2", "salt")
    rows = rows.groupBy("lang", *KEY, "salt").agg(F.sum("n").alias("n"))
    # sorted by a hash that differs for most rows, and not by the language, which is the same for most
    rows = rows.withColumn("first", F.xxhash64("w1", "w2"))
    by_three, by_two = (Window.partitionBy("first", "lang", "salt", *KEY[:k]) for k in (3, 2))
    rows = rows.withColumn("n3", F.sum("n").over(by_three)).withColumn("n2", F.sum("n").over(by_two))
    keep2 = (F.col("w2") != 0) & ((F.col("salt") > 0) | (F.col("n2") >= least))
    keep3 = keep2 & (F.col("w3") != 0) & ((F.col("salt") > salts) | (F.col("n3") >= least))
    keep4 = keep3 & (F.col("w4") != 0) & (F.col("n") >= least)
    kept = rows.select("lang", "w1", *[F.when(k, F.col(c)).otherwise(0).alias(c) for k, c in zip((keep2, keep3, keep4), KEY[1:])], "n")
    # most are cut to few different ones, so these are added up before ROLLUP makes five rows of each
    kept = kept.groupBy("lang", *KEY).agg(F.sum("n").alias("n"))
    summed = kept.rollup("lang", *KEY).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    length = F.when(F.col("level") == 0, 4).when(F.col("level") == 1, 3).when(F.col("level") == 3, 2).when(F.col("level") == 7, 1)
    summed = summed.withColumn("length", length).where(
        F.when(F.col("length") == 4, F.col("w4") != 0).when(F.col("length") == 3, F.col("w3") != 0).when(F.col("length") == 2, F.col("w2") != 0).otherwise(F.col("length") == 1)
    )
    phrases = summed.select("lang", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in KEY], "length", "f")
    return cut(phrases, "phrase-counts"), words, salt, hot


def _part(first: int, last: int) -> Column:
    """Words ``first`` to ``last`` of a phrase, padded, as a struct."""
    words = [F.col(KEY[i]) for i in range(first, last)] + [F.lit(0).cast("long")] * (LONGEST - last + first)
    return F.struct(*[w.alias(c) for w, c in zip(words, KEY)])


def collocations(docs: DataFrame, first: int = 2000, least: int = 30, salts: int = 64, sample_rows: int = 4096) -> DataFrame:
    """Each language's ``first`` phrases of ``docs`` (text, lang) by score: lang, rank, phrase, a, l, r, n, score.

    ASCII letters are lower-cased, texts split at ``.,;:!?`` and line ends into pieces, those at spaces and tabs into words.
    A candidate has two to four words and occurs ``least`` times. Its score is the least over its cuts in two of
    floor(2000000 * a / (l + r)), and of equal ones the first cut counts. Candidates inside a longer candidate that occurs at least
    80 % as often are left out. Equal scores go by count, then by the phrase's bytes.

    Repeated rows count as often as they are there; null texts have no words, a null language is ``und``; empty tables
    give no rows; columns other than text and lang are not looked at.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of("text").alias("text"))
    phrases, words, salt, hot = phrase_counts(docs, least, salts, sample_rows)
    zero = F.lit(0).cast("long")
    padded = [h.select("lang", *KEY[:k], *[zero.alias(c) for c in KEY[k:]], F.lit(salts).alias("copies")) for k, h in enumerate(hot, 1)]
    spread = F.broadcast(padded[0].union(padded[1]).union(padded[2]))
    counts = phrases.join(spread, ["lang", *KEY], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)))
    counts = counts.select("lang", *KEY, "salt", "f")
    candidates = phrases.where((F.col("length") >= 2) & (F.col("f") >= least)).withColumnRenamed("f", "a")

    def with_count(rows: DataFrame, part: str, name: str) -> DataFrame:
        """The count of the phrase in struct ``part``, very frequent ones being looked up in several places."""
        rows = rows.select("*", *[F.col(f"{part}.{c}").alias(f"p{c}") for c in KEY])
        keys = {c: f"p{c}" for c in KEY}
        rows = rows.join(spread.select("lang", *[F.col(c).alias(p) for c, p in keys.items()], "copies"), ["lang", *keys.values()], "left")
        rows = rows.withColumn("salt", F.pmod(F.xxhash64(*KEY), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
        return rows.join(counts.select("lang", *[F.col(c).alias(p) for c, p in keys.items()], "salt", F.col("f").alias(name)), ["lang", *keys.values(), "salt"]).drop("salt", *keys.values())

    cuts = F.when(F.col("length") == 2, F.array(*[F.struct(F.lit(1).alias("k"), _part(0, 1).alias("left"), _part(1, 2).alias("right"))]))
    for length in (3, 4):
        cuts = cuts.when(F.col("length") == length, F.array(*[
            F.struct(F.lit(k).alias("k"), _part(0, k).alias("left"), _part(k, length).alias("right")) for k in range(1, length)
        ]))
    rows = candidates.select("lang", *KEY, "length", "a", F.inline(cuts))
    rows = with_count(with_count(rows, "left", "l"), "right", "r")
    # decimals: the product can pass 64 bits; div is exact
    score = F.expr("cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + r) as long)")
    best = rows.withColumn("score", score).groupBy("lang", *KEY, "length", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inside = F.when(F.col("length") == 3, F.array(_part(0, 2), _part(1, 3))).when(
        F.col("length") == 4, F.array(_part(0, 2), _part(1, 3), _part(2, 4), _part(0, 3), _part(1, 4))
    )
    longer = candidates.where(F.col("length") > 2).select("lang", F.col("a").alias("longest"), F.inline(inside)).groupBy("lang", *KEY).agg(F.max("longest").alias("longest"))
    covered = F.expr("cast(longest as decimal(19,0)) * 100 >= cast(a as decimal(19,0)) * 80")
    best = best.join(longer, ["lang", *KEY], "left").where(~F.coalesce(covered, F.lit(False)))

    order = [F.desc("score"), F.desc("a")]
    by_lang = Window.partitionBy("lang")
    best = best.select("lang", *KEY, "a", "best.l", "best.r", "best.score")
    # the first of each bucket, then the first of those: no task orders all of a language
    for among in (Window.partitionBy("lang", "bucket"), by_lang):
        best = best.withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(256)))
        best = best.withColumn("rank", F.rank().over(among.orderBy(*order))).where(F.col("rank") <= first).drop("rank", "bucket")
    spelled = words.where(F.col("n") >= least).select("lang", "word", _hash(F.col("word"), salt).alias("h"))
    parts = best.select("*", F.posexplode(F.array(*KEY)).alias("place", "h")).where(F.col("h") != 0).join(spelled, ["lang", "h"])
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x.word), " ")
    best = parts.groupBy("lang", *KEY, "a", "l", "r", "score").agg(phrase.alias("phrase"))
    best = best.withColumn("rank", F.row_number().over(by_lang.orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= first)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
