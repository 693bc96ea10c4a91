import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.util import documents, texts_of_table
from tierline.llm import kneser_ney


START, END = ("start",), ("end",)  # told from any word


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [END]


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.pairs, self.counts, self.follow = Counter(), Counter(), defaultdict(Counter)
        for t in texts:
            w = words(t)
            self.counts.update(w)
            for a, b in zip([START, *w], w):
                self.pairs[a, b] += 1
                self.follow[a][b] += 1
        self.n, self.v = sum(self.counts.values()), len(self.counts)
        self.before = Counter(b for _, b in self.pairs)
        self.d = kneser_ney.discounts([sum(c == i for c in self.pairs.values()) for i in (1, 2, 3, 4)])
        self.e = kneser_ney.discounts([sum(c == i for c in self.before.values()) for i in (1, 2, 3, 4)])
        self.kept = sum(self.e[min(c, 3)] for c in self.before.values()) / max(1, len(self.pairs))

    def single(self, b):
        a = self.before[b]
        return max(a - self.e[min(a, 3)], 0) / max(1, len(self.pairs)) + self.kept / (self.v + 1)

    def after(self, a, b):
        follow = self.follow.get(a)
        if not follow:
            return self.single(b)
        total, c = sum(follow.values()), follow[b]
        left = sum(self.d[min(x, 3)] for x in follow.values()) / total
        return max(c - self.d[min(c, 3)], 0) / total + left * self.single(b)

    def row(self, text):
        w = words(text)
        base = sum(math.log10((self.counts[x] + 1) / (self.n + self.v + 1)) for x in w)
        return len(w), sum(x in self.counts for x in w), self.n, base, sum(math.log10(self.after(a, b)) for a, b in zip([START, *w], w))


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def compare(spark, rows):
    plain = Plain([t for i, t in rows if not out(i)])
    got = kneser_ney.perplexity(documents(spark, rows)).collect()
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got), key=repr)
    want = []
    for i, t in rows:
        n, known, total, base, score = plain.row(t)
        want.append((i, out(i), n, known, total, round(base, 5), round(score, 5)))
    want.sort(key=repr)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert np.allclose([f[5:] for f in found], [w[5:] for w in want], rtol=1e-6, atol=1e-4)
    return plain


def test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in texts_of_table()]
    plain = compare(spark, rows)
    held = [plain.row(t) for i, t in rows if out(i)]
    assert sum(r[4] for r in held) > sum(r[3] for r in held)  # better than single words on texts not learned from


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a a a a b"), (None, "a B\x0bc"), (None, None), (4, "the " * 3000), (5, "é中   x"), (6, "a b"), (6, "a b"), (7, "</s> <s> a")]
    compare(spark, rows)


def test_empty_and_nothing_to_learn(spark):
    assert kneser_ney.perplexity(documents(spark, [])).collect() == []
    held = next(i for i in range(100) if out(i))
    (row,) = kneser_ney.perplexity(documents(spark, [(held, "x y")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_probabilities_sum_to_one():
    plain = Plain(["a b a c", "b b a", "d a b a"])
    for context in ["a", "b", START, "never"]:
        total = sum(plain.after(context, w) for w in [*plain.counts, "unknown"])
        assert total == pytest.approx(1.0)


def test_files_of_many_shards(spark, place):
    from pyspark.sql import functions as F

    texts = [f"w{i % 9} w{i % 5} the w{i}" + " the" * (i % 3) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = kneser_ney.train(df, place("model"), shard_bytes=300, buffer=50)
    assert model.shards > 5 and len(model.spread)
    plain = Plain(texts)
    got = kneser_ney.score_texts(df.select(F.lit(1).alias("doc_id"), "text"), model).collect()
    assert np.allclose(sorted(r.score for r in got), sorted(plain.row(t)[4] for t in texts))
    assert (model.tokens, model.words, model.pairs) == (plain.n, plain.v, len(plain.pairs))


def test_large_counts_survive_narrow_storage(spark, place):
    df = spark.createDataFrame([("a b " * 700,)], "text string")
    model = kneser_ney.train(df, place("model"))
    out_, edges = kneser_ney.tokens([b"a b"])
    first = kneser_ney.contexts(out_, edges)
    assert model.pair_counts(first, out_).tolist() == [1, 700, 1]
