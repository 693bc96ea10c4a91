import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.util import documents, texts_of_table
from tierline.llm import runs
from tierline.llm.suffix import numbered, words_at_a_time


def brute(words):
    best = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                best.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def edited(doc_id, text):
    words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain(doc_id, text):
    words = edited(doc_id, text)
    found = brute(words)
    keep = [True] * len(words)
    for start, length, period in found:
        for i in range(start + period, start + length):
            keep[i] = False
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = b" ".join(w for w, k in zip(words, keep) if k)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def found(texts):
    codes, starts, _ = numbered(words_at_a_time(t.encode()) for t in texts)
    return runs.runs_of_block(codes, starts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=3), st.integers(1, 9)), max_size=8), max_size=4))
def test_runs_are_those_of_brute_force(parts):
    texts = [" ".join(c for chunk, times in text for c in chunk * times) for text in parts]
    assert found(texts) == [brute(t.split()) for t in texts]


def test_long_texts_of_one_word_and_of_long_periods():
    assert found(["a " * 30000]) == [[(0, 30000, 1)]]
    assert found([" ".join(str(i % 1000) for i in range(20000))]) == [[(0, 20000, 1000)]]
    assert found(["b " + "a b c " * 3000 + "a a c"])[0] == [(1, 9001, 3)]


def test_equal_texts_in_a_block_do_not_meet():
    text = " ".join(f"w{i}" for i in range(50))
    assert found([text] * 40) == [[]] * 40


def test_whole_table_is_as_by_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in texts_of_table()]
    got = runs.digest(documents(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(plain(*r) for r in rows)


def test_nulls_repeats_white_space_and_clashing_columns(spark):
    many = [(None, "x " * 9), (4, None), (4, ""), (5, " \t\x0b "), (7, "q r " * 6), (7, "q r " * 6), (12, "a " * 5), (13, "á é á é á é á é")]
    rng = random.Random(3)
    many += [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(100, 140)]
    got = runs.digest(documents(spark, many).withColumnRenamed("score", "runs").withColumnRenamed("source", "Collapsed")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain(*r) for r in many), key=repr)
    assert runs.digest(documents(spark, [])).count() == 0


def test_callers_columns_stay(spark):
    df = spark.createDataFrame([("v", "a " * 6, "t")], "id string, body string, whole_text string")
    row = runs.find_runs(df, "body", into="found", without="less", block_bytes=4).first()
    assert row.asDict(True) == {"id": "v", "body": "a " * 6, "whole_text": "t", "found": [{"start": 0, "length": 6, "period": 1}], "less": "a"}
    with pytest.raises(ValueError):
        runs.find_runs(df, "body", into="ID")
