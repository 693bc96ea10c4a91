"""Token counts by lookup of white-space-separated pieces, without shuffling any of them.

Tier one is a hash table of the lengths of frequent pieces, broadcast; its size is bounded by a
parameter. Tier two is a cache in each worker; what it lacks is encoded by the tokenizer library.
Both tiers only save work: every piece's length is the library's own.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import by_size, text_of

#: Characters on whose class Python's white space and a tokenizer's ``\s`` differ.
_SEPARATORS = re.compile("[\x1c-\x1f]")


class Lengths(dict):
    """Token counts of pieces: what was given or met before, else as the tokenizer encodes it."""

    def __init__(self, tokenizer, frequent: dict[str, int], most: int):
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.most = tokenizer, frequent, most

    def __missing__(self, piece: str) -> int:
        self[piece] = count = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return count

    def total(self, text: str) -> int:
        """Tokens of a text whose pieces can be encoded one by one."""
        count = sum(map(self.__getitem__, text.split()))
        if len(self) > self.most + len(self.frequent):  # start again from the frequent ones
            self.clear()
            self.update(self.frequent)
        return count


def splittable(tokenizer) -> bool:
    """Whether pieces between white space can be encoded one by one.

    True of tokenizers that drop white space before a split that never crosses it, which this
    probe of the library's own answers shows for the file at hand.
    """
    probe = "Ab cd's 12x ! ?? é́ß\n\t<b> q"
    whole = tokenizer.encode(probe, add_special_tokens=False).ids
    parts = [i for piece in probe.split() for i in tokenizer.encode(piece, add_special_tokens=False).ids]
    return whole == parts


def frequent_lengths(tokenizer) -> dict[str, int]:
    """Counts of the vocabulary's whole words, the pieces that the tokenizer's own corpus had most often.

    At most one entry for each vocabulary entry, so the table's size does not depend on the input.
    """
    words = [w.removesuffix("</w>") for w in tokenizer.get_vocab(with_added_tokens=False) if w.endswith("</w>")]
    words = [w for w in words if w.isascii() and w.isprintable()]
    return {w: len(e.ids) for w, e in zip(words, tokenizer.encode_batch_fast(words, add_special_tokens=False))}


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, cache_size: int = 1 << 19
) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_tokens, over_limit.

    Counts are over whole texts. A null text is empty and has no tokens; a null id and repeated rows
    stay as they are; other columns are left out, whatever their names. An empty table gives no rows.
    ``cache_size`` bounds the pieces that a worker remembers beside the broadcast ones.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(load_tokenizer(tokenizer_path)))

    def count(batches):
        tokenizer = load_tokenizer(tokenizer_path)
        lengths = Lengths(tokenizer, frequent.value, cache_size)
        by_piece = splittable(tokenizer)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        for block in by_size(batches, "text", 1 << 22):
            counts = []
            for text in block.column("text").to_pylist():
                if by_piece and not _SEPARATORS.search(text) and not any(s in text for s in special):
                    counts.append(lengths.total(text))
                else:
                    counts.append(len(tokenizer.encode(text, add_special_tokens=False).ids))
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("n_bytes"), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = picked.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
