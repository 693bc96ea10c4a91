import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.util import documents
from tierline.llm import language
from tierline.llm.common import held_out


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = language.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in found if r.held_out]
    assert len(found) == docs.count() and len(out) > 30
    assert np.mean([r.lang_pred == r.lang for r in out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_text_vector_is_the_sum_of_bound_letters():
    text, d = "Ab-cé b", 64
    plain = " ab cé b "
    want = np.zeros(d)
    for i in range(len(plain) - 2):
        product = np.ones(d)
        for distance, letter in enumerate(reversed(plain[i : i + 3])):
            product *= np.roll(language.letter_vector(ord(letter), d), distance)
        want += product
    got, empty = language.text_vectors([text, " 12 !"], d)[0]
    assert got.tolist() == want.tolist() and not empty.any()


def test_letters_outside_the_basic_plane_and_lone_surrogates():
    vectors = language.text_vectors(["\U00010400\U00010401 x", "中文文字", ""], 32)[0]
    assert vectors[0].any() and vectors[1].any() and not vectors[2].any()


def test_parts_of_a_text_have_its_grams_once():
    rng = np.random.default_rng(5)
    for _ in range(200):
        text = "".join(rng.choice(list("aB é-.1中"), rng.integers(0, 60)))
        whole = language.grams([f" {text.lower()} "])
        want = Counter({tuple(map(int, g)): int(n) for g, n in zip(spelled(*whole), whole[2])})
        got = Counter()
        for part in language.pieces(text, int(rng.integers(1, 12))):
            found = language.grams([part])
            got.update({tuple(map(int, g)): int(n) for g, n in zip(spelled(*found), found[2])})
        assert got == want


def spelled(owner, number, counts, alphabet):
    for n in number:
        yield [alphabet[n // len(alphabet) ** i % len(alphabet)] for i in range(language.GRAM)] if len(alphabet) else []


def test_long_texts_of_many_grams_take_bounded_memory():
    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA0, 1_500_000)))
    tracemalloc.start()
    vectors, sizes = language.text_vectors([text, "a b"], language.DIMENSIONS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250e6 and sizes[0] == len(text) and vectors[0].any()


def test_whole_table_is_as_by_a_plain_version(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()]
    d, known = language.DIMENSIONS, {}

    def vector(text):
        codes = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
        codes = re.sub(" +", " ", codes)
        counts = Counter(codes[i : i + 3] for i in range(len(codes) - 2))
        total = np.zeros(d)
        for gram, n in counts.items():
            if gram not in known:
                known[gram] = np.prod([np.roll(language.letter_vector(ord(c), d), k) for k, c in enumerate(reversed(gram))], axis=0)
            total += n * known[gram]
        return total, max(1, sum(counts.values()))

    sums = {}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2 and text is not None and lang is not None:
            total, n = vector(text)
            sums[lang] = sums.get(lang, 0) + total / n
    got = {r.doc_id: r for r in language.predictions(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        total, _ = vector(text)
        cosines = {lang: float(total @ s / np.linalg.norm(total) / np.linalg.norm(s)) for lang, s in sums.items()} if total.any() else {}
        best = max(cosines, key=cosines.get, default="und")
        assert got[i].lang_pred == best and abs(got[i].score - max(0, cosines.get(best, 0))) < 1e-4, i


def test_odd_rows(spark):
    rows = [
        (1, "the cat sat on the mat", "en"), (3, "le chat est sur la table", "fr"), (None, "the dog and the cat", "en"), (5, None, "en"), (6, "", None),
        (7, "123 ... !", "fr"), (8, "the mat", None), (8, "the mat", None), (9, "x" * 300_000 + " the cat sat", "en"),
    ]
    docs = spark.createDataFrame([(*r, "a", 0.5, "b") for r in rows], "doc_id long, text string, lang string, LANG_PRED string, score double, extra string")
    got = language.identify(docs, F.lit(True))
    assert got.columns == ["doc_id", "text", "lang", "extra", "lang_pred", "score"]
    by_text = {r.text: (r.lang_pred, r.score) for r in got.collect()}
    assert by_text["the mat"][0] == "en" and by_text["le chat est sur la table"][0] == "fr"
    assert by_text[None] == by_text[""] == by_text["123 ... !"] == ("und", 0.0)
    assert got.count() == len(rows)


def test_nothing_learned_and_empty(spark):
    docs = documents(spark, [(1, "some words"), (2, None)])
    assert {(r.lang_pred, r.score) for r in language.predictions(docs).collect()} == {("und", 0.0)}
    assert language.predictions(docs.where("false")).collect() == []


def test_held_out_is_by_crc_of_the_id(spark):
    import zlib

    ids = [None, -5, 0, 1, 2, 17, 10**12]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out("doc_id", 4, 2).alias("h")).collect()
    assert {r.doc_id: r.h for r in got} == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}
