import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import DATA
from tests.llm.util import documents, texts_of_table
from tierline.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", "a", "<|endoftext|> x<|endoftext|>", "中文 text é́  \n\n x's  ", "word " * 60_000, "x" * 30_000, "\x1c\x1d a  b", "😀 \U0001f600'll"]


def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, pieces, window=1024):
    """Every id of every document in one piece, every sequence gapless, the digests right."""
    ids = library()
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(ids(text))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        own = np.frombuffer(bytes(p.ids), "<u4")
        assert len(own) == p.length > 0 and zlib.crc32(bytes(p.ids)) == p.ids_crc32
    assert by_doc.keys() == want.keys()
    for doc_id, found in by_doc.items():
        found.sort(key=lambda p: (p.doc_tokens, p.start))
        together = [i for p in found for i in np.frombuffer(bytes(p.ids), "<u4").tolist()]
        assert sorted(together) == sorted(i for one in want[doc_id] for i in one)
        if len(want[doc_id]) == 1:
            assert together == want[doc_id][0] and {p.doc_tokens for p in found} == {len(together)}
            assert [p.start for p in found] == list(np.cumsum([0] + [p.length for p in found[:-1]]))
    padding = 0
    for found in by_sequence.values():
        found.sort(key=lambda p: p.offset)
        assert [p.offset for p in found] == list(np.cumsum([0] + [p.length for p in found[:-1]]))
        total = sum(p.length for p in found)
        assert total <= window
        padding += 0 if total & (total - 1) == 0 else window - total
    return padding


def test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in texts_of_table()]
    pieces = packing.pack(spark.read.parquet(f"{DATA}/documents.parquet"), PATH).collect()
    assert check(rows, pieces) < 1024


def test_odd_rows(spark):
    rows = [*enumerate(ODD), (3, "again"), (3, "again"), (None, "null id"), (None, None)]
    pieces = packing.pack(documents(spark, rows).coalesce(1), PATH).collect()
    assert check(rows, pieces) < 1024
    again = packing.pack(documents(spark, rows).coalesce(1), PATH).collect()
    assert [tuple(p) for p in pieces] == [tuple(p) for p in again]
    assert packing.pack(documents(spark, []), PATH).collect() == []


def test_few_open_windows(spark):
    rows = [(i, "stone " * (5 + i % 40)) for i in range(300)]
    pieces = packing.pack(documents(spark, rows).coalesce(1), PATH, window=64, most_open=3).collect()
    check(rows, pieces, 64)


def test_ids_are_the_librarys():
    encoder, ids = packing.Encoder(PATH), library()
    assert encoder.fast
    for text in [t for t in ODD if t] + [r["text"] for r in texts_of_table()]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(text)[:-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sltvre dm  \n\t\r1²½éßñ_-&#|. \u0085ªºµ\x1c😀中", max_size=60))
def test_ids_of_any_text(text):
    assert packing.encoder(PATH).encode(text) == packing.encoder(PATH).whole(text)


def test_long_texts_are_cut_where_encoding_is(monkeypatch):
    text = " ".join(f"word{i}  \n{i}" for i in range(2000))
    assert "".join(packing.stretches(text, 50)) == text and len(list(packing.stretches(text, 50))) > 100
    whole = packing.encoder(PATH).whole
    assert b"".join(map(whole, packing.stretches(text, 50))) == whole(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=60))
def test_a_piece_goes_where_squares_grow_least(sizes):
    packer = packing.Packer(16, 10**6)

    def squares(counts):
        return sum(c * c for h, c in enumerate(counts) if h & (h - 1) and h < 16)

    for n, size in enumerate(sizes):
        before = packer.counts.copy()
        best = None
        for level in range(0, 17 - size):
            if level == 0 or before[level]:
                after = before.copy()
                if level:
                    after[level] -= 1
                if level + size < 16:
                    after[level + size] += 1
                best = min(best if best is not None else squares(after), squares(after))
        packer.place([n, 0, bytes(4 * size)])
        assert squares(packer.counts) == best
