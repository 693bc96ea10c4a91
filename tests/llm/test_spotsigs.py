import hashlib
import os
import random
import re
import tempfile

from tests.llm.util import documents, texts_of_table
from tierline.llm import spotsigs


def spots(text):
    """Chains of three content words after the common words before them, as tuples."""
    words = [w for w in re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ") if w]
    if not words:
        return {("bare", text)} if text else set()
    common = set(spotsigs.COMMON)
    units, waiting = [], []
    for i, w in enumerate(words):
        if (w in common or len(w) <= 2) and i < len(words) - 1:
            waiting.append(w)
        else:
            units.append((tuple(waiting), w))
            waiting = []
    out = set()
    for i, (before, _) in enumerate(units):
        if before or i == 0:
            out.add((i == 0, before, tuple(u[1] for u in units[i : i + 3])))
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), len(spots(text)), round(jaccard(spots(text), spots(edited)), 9), round(jaccard(spots(text), spots(after)), 9)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    got = spotsigs.fingerprints(documents(spark, rows), **options).collect()
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, int(r.fingerprint.split(":")[0]), round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=repr)


def test_table_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in texts_of_table()]
    assert run(spark, rows, rows_per_bucket=1) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (5, "the old river ran by the stone bridge and the mill"), (5, "the old river ran by the stone bridge and the mill"), (1, None), (2, ""),
        (3, "..."), (4, "one"), (None, "null id of all"), (None, None), (10**15, "far the id away"), (-7, "é 中文 \U0001f600 the sign\n\nof it"), (8, "of the"),
        (9, "the word " * 20_000),
    ]
    for each in (1, 3, 1000):
        assert run(spark, rows, rows_per_bucket=each) == brute(rows)


def test_single_and_empty(spark):
    assert run(spark, [(1, "the only text there is")]) == brute([(1, "the only text there is")])
    assert run(spark, []) == []


def test_equal_texts_have_equal_fingerprints(spark):
    rows = [(i, t) for i, t in enumerate(["the same text and words", "another one of these", "the same text and words"])]
    found = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(documents(spark, rows)).collect()}
    assert found[0] == found[2] != found[1]


def test_no_python_in_the_plan(spark):
    plan = spotsigs.fingerprints(documents(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_likeness_is_pruned_by_size(spark):
    from pyspark.sql import functions as F

    df = spark.sql("select array(1) as a, array(1, 2, 3, 4) as b, cast(array() as array<int>) as e")
    got = df.select(spotsigs.likeness(F.col("a"), F.col("b")), spotsigs.likeness(F.col("a"), F.col("b"), 0.5), spotsigs.likeness(F.col("e"), F.col("e")), spotsigs.likeness(F.col("e"), F.col("a"))).first()
    assert tuple(got) == (0.25, 0.0, 1.0, 0.0)


def test_texts_without_common_words_are_covered_to_their_end(spark):
    from tierline.llm import queries

    def table(start, n):
        return " ".join(f"row{i}" for i in range(start, start + n))

    prose = "river stone window paper garden bridge castle forest"
    rows = [(1, table(100, 80)), (2, table(500, 90)), (3, prose), (4, "and " + table(900, 8)), (5, "\u7530" * 9 + " " + table(300, 40))]
    place = f"{tempfile.mkdtemp()}/documents.parquet"
    documents(spark, rows).write.parquet(place)
    got = {r.doc_id: r for r in queries.op3_spotsigs(spark, os.path.dirname(place)).collect()}
    for i in (1, 2, 3, 4, 5):
        assert 0 < got[i].near_edited < 1, i
    # each word far from the first is a spot, in chains of three
    assert int(got[1].fingerprint.split(":")[0]) == 1 + 80 - 8
    assert 0.4 < got[1].near_edited < 0.8


def test_words_far_from_a_spot(spark):
    from pyspark.sql import functions as F

    def plain(text, reach):
        out, since = [], 0
        for i, u in enumerate(spotted := units_of(text)):
            since = 1 if spotted[i][0] or i == 0 else since + 1
            out.append(bool(spotted[i][0]) or i == 0 or since > reach)
        if len(out) > 3 and not any(out[-3:]):
            out[-3] = True
        return out

    def units_of(text):
        out, waiting = [], False
        words = text.split()
        for i, w in enumerate(words):
            if (w in spotsigs.COMMON or len(w) <= 2) and i < len(words) - 1:
                waiting = True
            else:
                out.append((waiting, w))
                waiting = False
        return out

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "of"]) if rng.random() < share else f"word{i}" for i in range(n)) for n in range(1, 60) for share in (0, 0.05, 0.2, 0.6)]
    for reach in (1, 3, 8):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", spotsigs.units(F.col("t"), reach).alias("u"))
        for r in df.collect():
            assert ["\x01" in u for u in r.u] == plain(r.t, reach), (r.t, reach)
