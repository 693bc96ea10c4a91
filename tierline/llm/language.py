"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that depends on its code point alone. An n-gram's vector is
the product of its letters' vectors, each rolled by its distance from the n-gram's end; a text's vector is
the sum over its n-grams. A language's prototype is the sum over its labelled texts, each divided by its
number of n-grams, and a text belongs to the prototype with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tierline.llm.common import by_size, held_out, text_of

DIMENSIONS = 512
GRAM = 3
UNKNOWN = "und"
_SPACE = 32
_CODE_POINTS = 0x110000


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(_CODE_POINTS)), bool, _CODE_POINTS)


@cache
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([code, dimensions])).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


def gram_vectors(codes: np.ndarray, alphabet: np.ndarray, dimensions: int) -> np.ndarray:
    """A row for each n-gram, given as a number to the base of the alphabet's size."""
    base = np.array([letter_vector(int(c), dimensions) for c in alphabet])
    bound, rest = np.ones((len(codes), dimensions), np.int8), codes
    for distance in range(GRAM):
        rest, letter = np.divmod(rest, len(alphabet))
        bound *= np.roll(base, distance, axis=1)[letter]
    return bound.astype(np.float32)


def pieces(text: str, size: int = 1 << 19) -> Iterator[str]:
    """A text between spaces, in lower case, in parts that together have its n-grams, each once.

    A part begins with a letter, so that the space before it belongs to the one before, and goes on for
    what an n-gram that begins before its end still needs.
    """
    text, start = f" {text.lower()} ", 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and not text[end].isalpha():
            end += 1
        yield text[start : end + GRAM - 1]
        if end == len(text):
            return
        start = end
    yield text[start:]


def grams(padded: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Part number, n-gram and count, by part and n-gram, and the alphabet that n-grams are numbered by.

    What stands between letters is one space.
    """
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), "<u4")
    owner = np.repeat(np.arange(len(padded)), [len(t) for t in padded])
    codes = np.where(_letters()[codes], codes, _SPACE)
    kept = np.ones(len(codes), bool)
    kept[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE) | (owner[1:] != owner[:-1])
    codes, owner = codes[kept], owner[kept]
    present = np.zeros(_CODE_POINTS, bool)
    present[codes] = True
    alphabet = np.flatnonzero(present)
    place = np.zeros(_CODE_POINTS, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    letters = place[codes]
    number = np.zeros(max(0, len(codes) - GRAM + 1), np.int64)
    for i in range(GRAM):
        number = number * len(alphabet) + letters[i : len(number) + i]
    inside = owner[: len(number)] == owner[GRAM - 1 :] if len(number) else np.zeros(0, bool)
    owner, number = owner[: len(number)][inside], number[inside]
    span = max(1, len(alphabet)) ** GRAM
    if span * (len(padded) + 1) < 1 << 62:
        keys, counts = np.unique(owner * span + number, return_counts=True)
        return keys // span, keys % span, counts, alphabet
    pairs, counts = np.unique(np.stack([owner, number], axis=1), axis=0, return_counts=True)
    return pairs[:, 0], pairs[:, 1], counts, alphabet


#: N-grams whose vectors are held at a time, and bytes of text that are worked on at a time.
_HELD = 1 << 13
_BLOCK = 1 << 19


def text_vectors(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The vector of each text, all zero for one without letters, and its number of n-grams."""
    out, sizes = np.zeros((len(texts), dimensions)), np.zeros(len(texts), np.int64)
    group: list[tuple[int, str]] = []
    held = 0
    for number, text in enumerate(texts):
        for piece in pieces(text):
            if group and held + len(piece) > _BLOCK:
                _add_pieces(group, out, sizes, dimensions)
                group, held = [], 0
            group.append((number, piece))
            held += len(piece)
    if group:
        _add_pieces(group, out, sizes, dimensions)
    return out, sizes


def _add_pieces(group: list[tuple[int, str]], out: np.ndarray, sizes: np.ndarray, dimensions: int) -> None:
    owner, number, counts, alphabet = grams([piece for _, piece in group])
    owner = np.array([n for n, _ in group])[owner]
    np.add.at(sizes, owner, counts)
    known, place = np.unique(number, return_inverse=True)
    weights = counts.astype(np.float32)
    for at in range(0, len(known), _HELD):
        vectors = gram_vectors(known[at : at + _HELD], alphabet, dimensions)
        inside = np.flatnonzero((place >= at) & (place < at + _HELD)) if len(known) > _HELD else np.arange(len(place))
        edges = np.flatnonzero(np.diff(owner[inside], prepend=-1, append=-1))
        for start, end in zip(edges[:-1], edges[1:]):
            for first in range(start, end, _HELD):
                some = inside[first : min(end, first + _HELD)]
                out[owner[some[0]]] += weights[some] @ vectors[place[some] - at]


def learn(docs: DataFrame, trains: Column, text_col: str, lang_col: str, dimensions: int) -> dict[str, np.ndarray]:
    """The prototype of each language, over all rows that ``trains`` holds for and that have a text and a language.

    A task sums what it reads to one vector for each language; those are summed in two rounds, so no
    task takes more than a share of them. What comes back is one vector for each language.
    """

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for block in by_size(batches, "text", _BLOCK):
            vectors, sizes = text_vectors(block.column("text").to_pylist(), dimensions)
            vectors /= np.maximum(sizes, 1)[:, None]  # texts weigh the same however long they are
            languages = np.array(block.column("lang").to_pylist(), object)
            for language in set(languages.tolist()):
                sums[language] = sums.get(language, 0) + vectors[languages == language].sum(0)
        salt = TaskContext.get().partitionId() % 64
        rows = list(sums.items())
        columns = [pa.array([k for k, _ in rows], pa.string()), pa.array([salt] * len(rows), pa.int32()), pa.array([v.tobytes() for _, v in rows], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "salt", "vector"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v) for v in group["vector"]], axis=0)
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "salt": [0], "vector": [total.tobytes()]})

    schema = "lang string, salt int, vector binary"
    text, lang = F.col(f"`{text_col}`").cast("string"), F.col(f"`{lang_col}`").cast("string")
    rows = docs.where(trains & text.isNotNull() & lang.isNotNull()).select(lang.alias("lang"), text.alias("text"))
    sums = rows.mapInArrow(bundle, schema).groupBy("lang", "salt").applyInPandas(add, schema).groupBy("lang").applyInPandas(add, schema)
    return {r.lang: np.frombuffer(r.vector) for r in sums.collect()}


def identify(
    docs: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """All rows and columns of ``docs`` with lang_pred and score (the cosine, at least 0) after them, under these ``names``.

    Prototypes come from the rows that ``trains`` holds for; a language found there is the only use of
    ``lang_col``. A text that is null or has no letters, or any text if nothing could be learned, is
    ``und`` with score 0. Of equal cosines the first language by code point wins. Columns of ``docs``
    of those names are replaced; an empty table gives no rows. The prototypes, one vector for
    each language, are broadcast.
    """
    learned = learn(docs, trains, text_col, lang_col, dimensions)
    languages = sorted(learned)
    unit = np.array([learned[n] / (np.linalg.norm(learned[n]) or 1.0) for n in languages]).reshape(len(languages), dimensions)
    held = docs.sparkSession.sparkContext.broadcast((languages, unit))
    docs = docs.drop(*names)
    place = docs.columns.index(text_col)

    def predict(batches):
        languages, unit = held.value
        for block in by_size(batches, text_col, _BLOCK):
            # columns by place, as names may differ in case only
            texts = [t or "" for t in block.column(place).to_pylist()]
            found, scores = [], []
            for vector in text_vectors(texts, dimensions)[0]:
                norm = float(np.linalg.norm(vector))
                cosines = unit @ vector / norm if norm and languages else np.zeros(0)
                best = int(np.argmax(cosines)) if len(cosines) else -1
                found.append(languages[best] if best >= 0 else UNKNOWN)
                scores.append(min(1.0, max(0.0, float(cosines[best]))) if best >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], [*block.schema.names, *names])

    added = [StructField(names[0], StringType()), StructField(names[1], DoubleType())]
    return docs.mapInArrow(predict, StructType([*docs.schema.fields, *added]))


def predictions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document; a fourth is held out of learning."""
    out = held_out(id_col, 4, 2)
    rows = docs.select(F.col(f"`{id_col}`"), text_of(text_col).alias(text_col), F.col(f"`{lang_col}`"))
    return identify(rows, ~out, id_col, text_col, lang_col).select(F.col(f"`{id_col}`").alias("doc_id"), out.alias("held_out"), "lang_pred", "score")
