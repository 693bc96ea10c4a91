import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import DATA
from tests.llm.util import documents, texts_of_table
from tierline.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n", "A", "<|endoftext|> b <|startoftext|>c", "é́ É ǅ İ ß", "it's We'LL 12 3½", "中文字 😀😀", "a\x1cb \x1f c", " x y", "word " * 60_000, "q" * 5000]


def test_table(spark):
    tokenizer = token_counts.load_tokenizer(PATH)
    got = {r.doc_id: r for r in token_counts.count_tokens(spark.read.parquet(f"{DATA}/documents.parquet"), PATH).collect()}
    for r in texts_of_table():
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids)
        assert (got[r["doc_id"]].n_tokens, got[r["doc_id"]].over_limit, got[r["doc_id"]].n_bytes) == (n, n > 2048, len(r["text"].encode()))


def test_odd_rows(spark):
    tokenizer = token_counts.load_tokenizer(PATH)
    rows = [*enumerate(ODD), (3, "again"), (3, "again"), (None, "null id")]
    got = token_counts.count_tokens(documents(spark, rows), PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(documents(spark, []), PATH).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB'sLtvre \n\t\r1²½éÉßñİ_-&#|. \u0085́ªµ😀中<>", max_size=40))
def test_pieces_add_up(text):
    tokenizer = token_counts.load_tokenizer(PATH)
    assert token_counts.splittable(tokenizer)
    lengths = token_counts.Lengths(tokenizer, {}, 10)
    assert lengths.total(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_the_broadcast_table_is_bounded_by_the_vocabulary():
    tokenizer = token_counts.load_tokenizer(PATH)
    table = token_counts.frequent_lengths(tokenizer)
    assert 1000 < len(table) <= tokenizer.get_vocab_size() and table["the"] == 1
