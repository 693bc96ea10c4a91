import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from tests.conftest import DATA
from tierline.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, taken int, bucket string, target string"


def brute(rows):
    """doc_id, size, source_size, target and taken, by dealing the excess again until no source is above its limit."""
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, (_, t, _) in enumerate(rows)}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(size[k] for k, r in enumerate(rows) if r[2] == s) for s in sources}
    target, free, left = {}, set(sources), 1.5 * sum(total.values())
    while free:
        each = left / sum(weight[s] for s in free)
        above = {s for s in free if each * weight[s] >= 2 * total[s]}
        for s in above or free:
            target[s] = 2.0 * total[s] if above else each * weight[s]
        if not above:
            break
        left -= sum(target[s] for s in above)
        free -= above
    out = []
    for s in sources:
        done = 0
        own = [k for k, r in enumerate(rows) if r[2] == s]
        own.sort(key=lambda k: (hashlib.md5(("" if rows[k][0] is None else str(rows[k][0])).encode()).hexdigest(), rows[k][0] is not None, rows[k][0] or 0, size[k]))
        for k in own:
            n = size[k]
            taken = sum(max(0, min(n, math.floor(target[s]) - e * total[s] - done)) for e in (0, 1))
            out.append((rows[k][0], n, total[s], round(target[s], 6), taken))
            done += n
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, "b", "t") for r in rows], SCHEMA)
    got = mixing.mix(df, **options)
    return got, sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got.collect()), key=repr)


def test_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    for each in (1, 1 << 15):
        got, found = run(spark, rows, rows_per_bucket=each)
        assert found == brute(rows)
    by_source = defaultdict(lambda: [0, 0.0])
    source = {r[0]: r[2] for r in rows}
    for i, _, _, target, taken in found:
        by_source[source[i]][0] += taken
        by_source[source[i]][1] = target
    assert all(abs(t - g) <= 1 for t, g in by_source.values())


def test_odd_rows(spark):
    rows = [(i, "w " * (i % 7), "abc"[i % 3] if i % 5 else None) for i in range(40)]
    rows += [(100, "one two", "a")] * 5 + [(None, "x y z", "b"), (None, "x y z", "b"), (101, None, "c"), (102, "", "empty"), (103, "\x1c  z", "\U0001f600"), (104, "z", "￿")]
    _, found = run(spark, rows)
    assert found == brute(rows)


def test_empty_and_wordless(spark):
    assert run(spark, [])[1] == []
    assert run(spark, [(1, " ", "a"), (2, None, None)])[1] == brute([(1, " ", "a"), (2, None, None)])


def test_rows_are_sorted_by_training_position(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(300)]
    got = mixing.mix(spark.createDataFrame([(*r, 1, 2, "b", "t") for r in rows], SCHEMA)).collect()
    places = [r.position for r in got if r.position is not None]
    assert places == sorted(places) and all(0 <= p <= 1 for p in places)
    assert [r.position for r in got][len(places) :] == [None] * (len(got) - len(places))


@pytest.mark.parametrize("first, last", [(1.0, 1.0), (0.5, 1.5), (1.5, 0.5), (0.0, 2.0), (2.0, 0.0)])
def test_position_inverts_the_integrated_weight(spark, first, last):
    from pyspark.sql import functions as F

    df = spark.range(101).select((F.col("id") / 100).alias("share"))
    for r in df.select("share", mixing.position(F.col("share"), F.lit(first), F.lit(last)).alias("t")).collect():
        integral = (first * r.t + (last - first) * r.t**2 / 2) / ((first + last) / 2)
        assert integral == pytest.approx(r.share, abs=1e-9)


def test_a_rising_source_comes_late(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(900)]
    got = mixing.mix(spark.createDataFrame([(*r, 1, 2, "b", "t") for r in rows], SCHEMA), weights=(1, 1, 1), share=1.0).collect()
    late = Counter("abc"[r.doc_id % 3] for r in got if r.position > 0.5)
    assert late["b"] > late["a"] > late["c"]


@pytest.mark.parametrize("each", [3, 1 << 15])
def test_rows_in_training_order_are_those_that_the_mix_takes(spark, each):
    from pyspark.sql import functions as F

    rows = [(i, "w " * (i % 9), "abc"[i % 3] if i % 7 else None) for i in range(200)] + [(7, "x y", "a")] * 4 + [(None, "z", None), (8, None, "b")]
    df = spark.createDataFrame([(*r, 1, 2, "b", "t") for r in rows], SCHEMA)
    plan = mixing.mix(df, rows_per_bucket=each).select("doc_id", F.explode("passes").alias("p")).collect()
    got = mixing.in_training_order(df, F.col("doc_id"), rows_per_bucket=each)
    assert got.columns == df.columns
    found = [(r.doc_id, r.text) for r in got.collect()]
    assert Counter(i for i, _ in found) == Counter(r.doc_id for r in plan)
    assert set(found) <= {r[:2] for r in rows}
    # a source's rows are in the order of their positions, whatever the ranges
    place = defaultdict(list)
    for r in plan:
        place[r.doc_id].append(r.p.position)
    source = {r[:2]: r[2] for r in rows}
    for name in "abc":
        own = [i for i, t in found if source[i, t] == name and i != 7]
        want = [i for _, i in sorted((p, i) for (i, t), s in source.items() if s == name and i != 7 and (i, t) != (7, "x y") for p in place.get(i, []))]
        assert Counter(own) == Counter(want) and sum(a != b for a, b in zip(own, want)) <= len(want) // 20
    assert mixing.in_training_order(df.where("false"), F.col("doc_id")).count() == 0
    assert mixing.in_training_order(spark.createDataFrame([(1, " ", "a", 1, 2, "b", "t")], SCHEMA), F.col("doc_id")).count() == 0
