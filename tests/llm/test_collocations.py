import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tierline.llm import collocations as c


def plain(rows, first=2000, least=30):
    f = defaultdict(Counter)
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        longest = Counter()
        for g, a in candidates.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    longest[g[i : i + k]] = max(longest[g[i : i + k]], a)
        best = []
        for g, a in candidates.items():
            if 100 * longest[g] < 80 * a or g not in longest:
                score, k = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g)))
                best.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        n = sum(a for g, a in counts.items() if len(g) == 1)
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(best)[:first], 1)]
    return sorted(out)


def corpus(seed, texts=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Été", "the", "OF", "\x00x", "rare" + str(seed)]
    phrase = ["New", "york", "city", "hall", "tower"]
    rows = []
    for _ in range(texts):
        ws = [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 20, 60]))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(ws))
            ws[at:at] = phrase[: rng.randint(2, 5)]
        rows.append((rng.choice(["en", "en", "de", None]), "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ";"]) for w in ws)))
    return rows + [(None, None), ("en", ""), ("fr", " ?! ")]


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, 1, "x", 2.0) for lang, text in rows], "lang string, text string, w1 int, phrase string, n double")


def run(spark, rows, **options):
    return sorted(map(tuple, c.collocations(frame(spark, rows), **options).collect()))


@pytest.mark.parametrize("seed,first,sample", [(1, 2000, 4096), (2, 7, 4096), (3, 2000, 0)])
def test_phrases_are_those_of_brute_force(spark, seed, first, sample):
    rows = corpus(seed) * 2
    want = plain(rows, first, 20)
    assert run(spark, rows, first=first, least=20, salts=5, sample_rows=sample) == want and len(want) > 10


def test_windows_go_on_over_buffers_texts_and_parts(spark, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(c, "_SEGMENT", 40)
    docs = frame(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).coalesce(1)
    got = Counter()
    for r in c.windows(docs, "s", b"\xff" * (c._BITS // 8), buffer=7).collect():
        got[r.lang, tuple(v for v in (r.w1, r.w2, r.w3, r.w4) if v)] += r.n
    want = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", tuple(ws[i : i + 4])) for i in range(len(ws)))
    hashed = {r.word: r.h for r in docs.sparkSession.createDataFrame([(w,) for _, g in want for w in g], "word string").select("word", c._hash(F.col("word"), "s").alias("h")).collect()}
    assert got == Counter({(lang, tuple(hashed[w] for w in g)): n for (lang, g), n in want.items()})
    counted = {(r.lang, r.word): r.n for r in c.word_counts(docs, buffer=3).collect()}
    assert counted == Counter({(lang, g[0]): sum(n for (x, h), n in want.items() if x == lang and h[0] == g[0]) for lang, g in want})


def test_one_word_a_third_of_all(spark):
    rng = random.Random(9)
    rows = [("en", " ".join(x for _ in range(50) for x in ("the", f"a{rng.randrange(30)}", f"b{rng.randrange(3)}"))) for _ in range(60)] + [("en", "la " * 5000)]
    assert run(spark, rows, salts=4) == plain(rows)


def test_words_of_one_hash_are_told_apart(spark):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    assert c._distinct_hashes(words) == ""
    assert c._distinct_hashes(words.union(words)) == ""


def test_empty_tables(spark):
    assert run(spark, []) == [] == run(spark, [(None, None), ("en", " . ")])


def test_windows_are_added_up_before_rollup_repeats_them(spark, monkeypatch):
    plans, cut = [], c.cut

    def seen(df, label):
        if label == "phrase-counts":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, label)

    monkeypatch.setattr(c, "cut", seen)
    rows = corpus(5) * 2
    assert run(spark, rows, least=20, salts=5) == plain(rows, 2000, 20)
    below = plans[0].split("Expand", 1)[1].splitlines()
    assert "Aggregate" in below[1] and "Window" in plans[0]
