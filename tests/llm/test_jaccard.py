import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.util import WORDS, documents
from tierline.llm import jaccard


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def run(spark, rows, **options):
    return sorted((tuple(r) for r in jaccard.similar_components(documents(spark, rows), **options).collect()), key=repr)


def corpus(seed, passages=2, texts=18):
    """Groups of near copies by chains of edits, and texts that share a passage only."""
    rng = random.Random(seed)
    passage = [rng.choice(WORDS) + str(rng.randint(0, 50)) for _ in range(25)]
    rows = []
    for _ in range(texts):
        words = [rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(rng.choice([3, 6, 12, 30, 60, 200]))]
        if rng.random() < 0.5:
            words += passage
        for _ in range(rng.randint(1, 6)):
            rows.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1])] = [f"new{rng.randint(0, 999)}"] * rng.choice([0, 1, 1])
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


def test_matches_brute_force(spark):
    for seed in range(3):
        rows = corpus(seed)
        assert run(spark, rows) == brute(rows)


def test_with_every_signature_frequent(spark):
    rows = corpus(7)
    assert run(spark, rows, share=0.0) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"), (7, "a b c d e"), (8, "A b\nc  d\x0be"), (9, "é É x y z"), (None, "a b c d e"),
        (None, "only null here it is"), (10, long), (11, long + " end"), (12, "  \x1c"), (13, "same words here again ok"), (13, "quite other words than those before"),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1)]


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.integers(1, 90), st.integers(91, 3000)), st.integers(0, 10**6), st.booleans())
def test_similar_sets_share_a_kept_signature(size, seed, order):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    both = a.tolist()
    for _ in range(int(rng.integers(0, max(1, size // 4) + 1))):
        if both and rng.random() < 0.5:
            both.pop(int(rng.integers(len(both))))
        else:
            both.append(int(rng.integers(0, 1 << 63)))
    b = np.unique(np.array(both, np.uint64))
    shared = len(np.intersect1d(a, b))
    if not len(b) or 100 * shared < 80 * (len(a) + len(b) - shared):
        return
    late = np.zeros(0, np.uint64)
    if order:
        late = np.sort(np.concatenate([jaccard.signatures(a, n) for n in jaccard.bands(len(a))])[::2])
    assert np.intersect1d(jaccard.kept_signatures(a, late), jaccard.kept_signatures(b, late)).size


def test_large_sets_rarely_keep_all_signatures():
    rng = np.random.default_rng(5)
    for size in (1, 2, 7, 8, 31, 63, 127, 128, 255, 256, 511, 1023, 2047, 4095, 16383, 65535):
        for _ in range(5 if size > 2000 else 40):
            own = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            for band in jaccard.bands(len(own)):
                assert len(jaccard.signatures(own, band)) > jaccard.furthest(len(own))


def test_large_sets_with_a_common_part_rarely_meet():
    rng = np.random.default_rng(6)
    none = np.zeros(0, np.uint64)
    for size in (300, 1000, 4000):
        part = rng.integers(0, 1 << 63, size // 10).astype(np.uint64)
        kept = [jaccard.kept_signatures(np.unique(np.concatenate([part, rng.integers(0, 1 << 63, size).astype(np.uint64)])), none) for _ in range(40)]
        shared = [len(np.intersect1d(a, b)) / len(a) for i, a in enumerate(kept) for b in kept[:i]]
        assert np.mean(shared) < 0.03


def test_pairs_of_one_centre_are_dealt_over_tasks(spark):
    pairs = spark.range(1000).selectExpr("7L as u", "id + 100 as v")
    held = spark.createDataFrame([(7, 70), (8, 80)], "u long, a long")
    joined = jaccard._join_u(pairs, held)
    assert joined.select("u", "a").distinct().collect() == [(7, 70)] and joined.count() == 1000
    salts = pairs.selectExpr(f"pmod(xxhash64(v), {jaccard._SALTS}) as salt").groupBy("salt").count().toPandas()["count"]
    assert salts.max() < 60


def test_parities_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(3)
    for size in (1, 5, 40, 900, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: len(a) - size // 9], rng.integers(0, 1 << 63, size // 7 + 1).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert jaccard.differing(jaccard.parities(a), jaccard.parities(b)) <= apart
        assert jaccard.differing(jaccard.fine_parities(a), jaccard.fine_parities(b)) <= apart
        assert jaccard.differing(jaccard.fine_parities(a), jaccard.fine_parities(b[: len(b) // 3 + 1])) <= len(np.setxor1d(a, b[: len(b) // 3 + 1]))


def test_most_apart_is_what_similar_sets_can_differ_in():
    for a in range(1, 80):
        for b in range(1, 100):
            fits = [s for s in range(min(a, b) + 1) if 100 * s >= 80 * (a + b - s)]
            if fits:
                assert jaccard.most_apart(a, b) == a + b - 2 * fits[0]


def test_furthest_bounds_every_similar_pair():
    for a in range(1, 200):
        for b in range(1, 260):
            overlap = -(-80 * (a + b) // 180)
            if overlap <= min(a, b):
                assert a + b - 2 * overlap <= min(jaccard.furthest(a), jaccard.furthest(b))
                assert set(jaccard.bands(a)) & set(jaccard.bands(b))


def test_sets_match_plain_shingles():
    texts = ["", "a", "A b  c", "x y z x y z x y", "é\n" * 9, " lead and trail ", "p q r s t u"]
    sets = jaccard.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    again = jaccard.shingle_sets([t.encode() for t in reversed(texts)])
    assert all(a.tolist() == b.tolist() for a, b in zip(sets, reversed(again)))


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(0, 60) if i != 30] + [(100, 100), (7, 3), (3, 7)]
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: 0 if i <= 30 else 31 for i in range(61) if i not in (0, 31)}


def test_further_links_connect_components(spark):
    roots = jaccard.components(spark.createDataFrame([(1, 2), (2, 3), (10, 11), (20, 21)], "u long, v long"))
    more = spark.createDataFrame([(3, 11), (30, 31), (31, 40), (2, 1)], "u long, v long")
    got = {r.node: r.root for r in jaccard.joined_components(roots, more).collect()}
    assert got == {2: 1, 3: 1, 10: 1, 11: 1, 21: 20, 31: 30, 40: 30}
    none = spark.createDataFrame([], "u long, v long")
    assert {r.node: r.root for r in jaccard.joined_components(roots, none).collect()} == {2: 1, 3: 1, 11: 10, 21: 20}


def test_two_python_steps_never_share_a_stage(spark, monkeypatch):
    plans, cut = [], jaccard.cut

    def seen(df, label):
        if label == "sets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, label)

    monkeypatch.setattr(jaccard, "cut", seen)
    rows = corpus(3)
    assert run(spark, rows) == brute(rows)
    assert plans
    for plan in plans:
        above, between, _ = plan.split("MapInArrow", 2)
        assert "Exchange hashpartitioning(node" in between and "Exchange hashpartitioning" not in above
