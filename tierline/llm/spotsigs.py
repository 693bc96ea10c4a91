"""Document fingerprints from spots: common words and the content words that follow them.

Built from SQL functions alone. A text is lower-cased, and what is not a letter or digit separates its
words. Common words stand before the content word they lead to; such a place, and the first word, is a
spot. Tables, lists, code and scripts without those words have long stretches without a spot; ``reach`` makes
each word there one as well. The signature of a spot is a 32-bit hash of the common words and of the chain of ``CHAIN`` content words from
there on. A fingerprint is the set of signatures, led by its size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import text_of

#: Frequent words of English, French, German and Spanish; words of one or two letters are added by rule.
COMMON = (
    "the and that was for are with this from have not you but his her they which one all their has been were when who will "
    "les des une est que qui dans pour par sur pas plus avec son ses aux mais ont cette "
    "der die das und den von mit sich des auf für ist dem ein eine nicht auch als bei nach wie aus "
    "los las del una por con para como más pero sus este esta entre cuando"
).split()
_MARK = "\x01"
_FAR = "\x02"
_ANCHOR = "(?<![^ ])(" + "|".join(dict.fromkeys(COMMON)) + r"|[^ ]{1,2}) (?=[^ ])"


def units(text: Column, reach: int | None = None) -> Column:
    """The content words, each after the common words before it and a mark; the first always has a mark.

    With ``reach``, so do those that ``reach`` or more content words stand before since the last common word:
    where an edit far from a word does not change whether it has one. So does the third word from the end if
    the last three would have none.
    """
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    marked = F.concat(F.lit(_MARK), F.regexp_replace(words, _ANCHOR, "$1" + _MARK))
    if reach is not None:
        # from a mark over reach - 1 words without one, or from the word before, to the next word without one
        far = rf"({_MARK}[^ ]*+(?: [^ {_MARK}]++(?= )){{{reach - 1}}}|\G(?!^)) ([^ {_MARK}]++)(?= |$)"
        marked = F.regexp_replace(marked, far, f"$1 {_FAR}{_MARK}$2")
        marked = F.regexp_replace(marked, rf" ([^ {_MARK}]++ [^ {_MARK}]++ [^ {_MARK}]++)$", f" {_FAR}{_MARK}$1")
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(marked, " "))


def spots(units: Column, text: Column) -> Column:
    """The set of signatures, sorted; of a text without letters and digits, the hash of the text; of an empty one, none."""

    def content(unit: Column) -> Column:
        return F.substring_index(unit, _MARK, -1)

    pairs = F.zip_with(units, F.slice(units, 2, F.size(units)), lambda a, b: F.struct(a.alias("a"), content(b).alias("b")))
    hashes = F.zip_with(
        pairs, F.slice(units, 3, F.size(units)),
        lambda p, c: F.when(F.instr(p["a"], _MARK) > 0, F.hash(p["a"], p["b"], content(c))),
    )
    bare = F.when(text == "", F.array().cast("array<int>")).otherwise(F.array(F.hash(text)))
    return F.when(F.size(units) == 0, bare).otherwise(F.array_sort(F.array_distinct(F.array_compact(hashes))))


def fingerprint(spots: Column) -> Column:
    """The set as text: its size, and eight hexadecimal digits for each signature."""
    digits = F.transform(spots, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.concat(F.size(spots).cast("string"), F.lit(":"), F.array_join(digits, ""))


def length_class(spots: Column, least: float) -> Column:
    """The partition of sets by size: sets whose likeness can be ``least`` are in one class or in neighbours."""
    return F.floor(F.log(F.greatest(F.size(spots), F.lit(1)).cast("double")) / math.log(1 / least)).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two sets, 1 of two empty ones; 0 without comparing if their sizes alone keep it under ``least``."""
    smaller, larger = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    compared = shared / (F.size(a) + F.size(b) - shared)
    return F.when(larger == 0, 1.0).when(smaller / larger < least, 0.0).when(smaller == 0, 0.0).otherwise(compared)


def in_order(rows: DataFrame, rows_per_bucket: int) -> DataFrame:
    """``rows`` (id, text) with a bucket, and guest rows: each bucket's last row is followed by the next one's first.

    Buckets are ranges of ids: 128 between quantiles, each cut evenly into as many as the number of rows
    asks for; null ids are the last bucket. The last bucket's guest is the first row of all.
    """
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(F.col("id").cast("double"), [i / 128 for i in range(129)], 10000).alias("q")).first()
    marks = sorted(set(shape.q or [0.0]))
    each = max(1, -(-shape.n // (rows_per_bucket * max(1, len(marks) - 1))))
    edges = F.array(*[F.lit(float(m)) for m in marks])
    place = F.size(F.filter(F.lit(marks), lambda m: m <= F.col("id").cast("double")))
    low, high = F.get(edges, place - 1), F.get(edges, place)
    part = F.least(F.lit(each - 1), F.floor((F.col("id").cast("double") - low) / F.greatest(high - low, F.lit(1e-9)) * each))
    bucket = F.when(F.col("id").isNull(), F.lit((len(marks) + 1) * each)).otherwise(place * each + F.coalesce(part, F.lit(0)))
    rows = rows.withColumn("bucket", bucket.cast("long"))
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("id", "text")).alias("first"))
    around = Window.orderBy("bucket")
    earlier = F.coalesce(F.lag("bucket").over(around), F.max("bucket").over(Window.partitionBy(F.lit(1))))
    guests = firsts.select(F.col("first.id").alias("id"), F.col("first.text").alias("text"), earlier.alias("bucket"), F.lit(True).alias("guest"))
    return rows.withColumn("guest", F.lit(False)).unionByName(guests)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.0, rows_per_bucket: int = 512,
    reach: int | None = None,
) -> DataFrame:
    """One row per document, with its fingerprint and those of an edited text and of the next document.

    ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    length_class. The edited text has its last quarter replaced by as much of the next document's start,
    in the order of ids, null ids last, equal ids by text; the last one's next is the first. A null text
    is empty. Other columns are left out, whatever their names; an empty table gives no rows, and a
    single document is its own next. ``reach`` is that of ``units``; without it only common words lead to spots.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    rows = in_order(rows, rows_per_bucket)
    order = Window.partitionBy("bucket").orderBy("guest", "id", "text")
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))
    rows = rows.withColumn("edited", edited).drop("next_text")
    rows = rows.withColumns({"units": units(F.col("text"), reach), "edited_units": units(F.col("edited"), reach)})
    rows = rows.withColumns({"spots": spots(F.col("units"), F.col("text")), "edited_spots": spots(F.col("edited_units"), F.col("edited"))})
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("units", "edited_units", "edited")
    rows = rows.withColumn("next_spots", F.lead("spots").over(order)).where(~F.col("guest"))
    return rows.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"), likeness(F.col("spots"), F.col("edited_spots"), least).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots"), least).alias("near_next"), length_class(F.col("spots"), 0.8).alias("length_class"),
    )
