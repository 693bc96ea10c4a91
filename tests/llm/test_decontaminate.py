import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.util import WORDS, documents
from tierline.llm import decontaminate as d
from tierline.llm.suffix import numbered, words_at_a_time


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(texts, items, size=10):
    """Of each text its number of words, spans and items, by comparing everything with everything."""
    out = []
    for text in texts:
        own = words(text)
        hit, ids = [False] * len(own), set()
        for item, body in items:
            ws = words(body)
            for i in range(max(1, len(ws) - size + 1) if ws else 0):
                phrase = ws[i : i + size]
                for at in range(len(own) - len(phrase) + 1):
                    if own[at : at + len(phrase)] == phrase:
                        hit[at : at + len(phrase)] = [True] * len(phrase)
                        ids |= {item} - {None}
        edges = [i for i in range(len(own) + 1) if (i < len(own) and hit[i]) != (i > 0 and hit[i - 1])]
        out.append((len(own), list(zip(edges[::2], edges[1::2])), sorted(map(str, ids))))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = rng.choice([list("ab"), WORDS, WORDS + [str(i) for i in range(40)]])
    texts = [rng.choice([" ", "-", "\x00"]).join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 9, 10, 60]))) for _ in range(8)]
    items = []
    for number in range(rng.randint(0, 8)):
        own = words(rng.choice(texts))
        at = rng.randrange(len(own) + 1)
        cut = own[at : at + rng.randint(0, 14)] if rng.random() < 0.6 else [rng.choice([*vocabulary, "unseen"]) for _ in range(rng.randint(0, 12))]
        items.append((rng.choice([number, number, 1, None]), " ".join(cut).upper()))
    return texts, items


@pytest.mark.parametrize("seed", range(60))
def test_shards_of_any_size_find_what_brute_force_finds(seed):
    texts, items = corpus(seed)
    wanted = d.Phrases.of([(None if i is None else str(i), t) for i, t in items], 10)
    codes, starts, known = numbered(words_at_a_time(t.encode().translate(d._FOLD)) for t in texts)
    for shard in (3, 25, 10000):
        change, pairs = d.hits(codes, starts, known, wanted, shard)
        covered = np.cumsum(change) > 0
        for number, (start, (n, spans, ids)) in enumerate(zip(starts, plain(texts, items))):
            assert covered[start : start + n].tolist() == [any(a <= i < b for a, b in spans) for i in range(n)]
            got = {wanted.items[p % len(wanted.items)] for p in pairs.tolist() if p // len(wanted.items) == number}
            assert sorted(got - {None}) == ids


def test_index_ranks_and_places():
    rng = np.random.default_rng(1)
    codes = np.append(rng.integers(1, 5, 300), 0)
    index = d.FMIndex(codes.astype(np.int32), np.array([0]), 4, sample=7)
    for length in (1, 2, 5):
        phrases = np.array([codes[i : i + length] for i in range(50)])
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases, low, high):
            want = [i for i in range(301 - length) if (codes[i : i + length] == phrase).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("seed", range(3))
def test_items_in_blocks_and_texts_in_pieces(spark, seed):
    texts, items = corpus(seed)
    docs = documents(spark, list(enumerate(texts))).withColumnRenamed("n_chars", "whole_text")
    marks = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(0))
    found = d.find_phrases(docs, marks, shard_bytes=60, shard_words=12, item_bytes=20)
    got = {r.doc_id: (r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == [(n, s, i) for n, s, i in plain(texts, items)]
    assert found.columns == [*docs.columns, "n_words", "spans", "items"]
    with pytest.raises(ValueError):
        d.find_phrases(docs.withColumn("SPANS", F.lit(1)), marks)


def test_nulls_repeats_and_empty_tables(spark):
    docs = documents(spark, [(1, "The river, the Stone"), (1, "The river, the Stone"), (None, "river the"), (2, None), (3, "... \x00")])
    marks = spark.createDataFrame([("9", "RIVER the"), ("10", "stone"), ("10", "stone"), (None, "the"), ("8", None), ("7", "!?")], "item_id string, text string")
    digest = lambda items: hashlib.sha256(",".join(items).encode()).hexdigest()
    got = sorted(map(tuple, d.digest(docs, marks).collect()), key=repr)
    full = (1, 4, 4, 2, digest(["10", "9"]), True)
    assert got == sorted([full, full, (None, 2, 2, 1, digest(["9"]), True), (2, 0, 0, 0, digest([]), False), (3, 0, 0, 0, digest([]), False)], key=repr)
    none = d.digest(docs, marks.where("false")).collect()
    assert len(none) == 5 and not any(r.contaminated for r in none)
    assert d.digest(docs.where("false"), marks).count() == 0
