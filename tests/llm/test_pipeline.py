import corpus_pipeline
from tests.conftest import DATA
from tests.llm import test_jaccard, test_mixing, test_packing
from tierline.llm import language
from tierline.llm.common import cut

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, position int"


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = cut(STAGES["language"](spark, docs, DATA), "t")
    found = {r.doc_id: r.lang_pred for r in language.predictions(docs).collect()}
    assert rows_of(kept) == [r for r in rows_of(docs) if found[r[0]] != language.UNKNOWN] and kept.columns == docs.columns

    single = cut(STAGES["jaccard"](spark, kept, DATA), "t")
    groups = {i: c for i, _, c in test_jaccard.brute([(r[0], r[1]) for r in rows_of(kept)])}
    assert rows_of(single) == [r for r in rows_of(kept) if groups[r[0]] == r[0]] and single.columns == docs.columns

    mixed = cut(STAGES["mixing"](spark, single, DATA), "t")
    assert mixed.columns == docs.columns
    taken = {i: (n, t) for i, n, _, _, t in test_mixing.brute([(r[0], r[1], r[3]) for r in rows_of(single)])}
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    total = sum(t for _, t in taken.values())
    assert abs(sum(taken[i][0] * n for i, n in times.items()) - total) <= 0.05 * total + 2000

    pieces = STAGES["packing"](spark, mixed, DATA).collect()
    test_packing.check([(r[0], r[1]) for r in rows_of(mixed)], pieces)


def test_run_is_the_stages_together(spark):
    pieces = corpus_pipeline.run(spark, DATA)
    assert pieces.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns)


def test_odd_rows(spark):
    text = "the old river ran by the stone bridge and the mill of the town"
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", "b"), (2, "an other text for the same id that is not like it", "en", None), (None, text, None, None)]
    rows += [(None, "no id here but words of its own to read", None, "a"), (5, None, "en", "a"), (6, "", "en", "a"), (7, "123", "en", "a"), (8, "short", "en", "a"), (9, text * 3000, "en", "a")]
    docs = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA)
    kept = STAGES["language"](spark, docs, DATA)
    assert {r.doc_id for r in kept.collect()} == {1, 2, None, 8, 9} and kept.columns == docs.columns
    single = STAGES["jaccard"](spark, docs, DATA)
    assert single.columns == docs.columns
    # of the five rows with that text the null id stands first
    assert sorted((r[0], (r[1] or "")[:20]) for r in rows_of(single) if r[0] is not None) == sorted(
        [(2, "an other text for th"), (5, ""), (6, ""), (7, "123"), (8, "short"), (9, text[:20])]
    )
    mixed = STAGES["mixing"](spark, docs, DATA)
    assert mixed.columns == docs.columns and mixed.count() > 0
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0, name
