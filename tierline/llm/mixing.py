"""Sources mixed to target sizes along a curriculum that changes over training.

Each source has a weight that goes linearly from a first to a last value over training time 0 to 1.
Its integral, scaled to the source's target, is the source's cumulative demand. The documents of a
source stand in an order by digest of their id; the words before a document, in each pass over the
source, are put through the inverse of the demand and give its training positions. All sources are
then sorted together by position, over ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import WORD, cut, text_of

WEIGHTS = (5, 2, 1)
#: Rows of the table of buckets that are broadcast, about 100 bytes each; more of them are joined by a shuffle.
_MOST_BROADCAST = 1 << 20
#: First and last weight over training, for the sources in turn: steady, rising, falling.
RAMPS = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))


def in_turn(values: Sequence[float], turn: Column) -> Column:
    """The value for a source's place in the order of sources, the values repeating."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (turn % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """key, source_size, turn and target for each source (one row each; the table of sources is small).

    ``share`` of all words is dealt by weight; a source stops at ``most`` times its size and its excess
    goes to the others by weight. Sources in the order of the share at which they stop: one stops if
    what the earlier ones leave gives it at least its limit.
    """
    by_key, everything = Window.orderBy("key"), Window.partitionBy(F.lit(1))
    by_limit = Window.orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    sources = sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    sources = sources.withColumn("turn", F.row_number().over(by_key) - 1)
    sources = sources.select("*", in_turn([int(w) for w in weights], F.col("turn")).alias("weight"), (F.col("source_size") * most).alias("cap"))
    sources = sources.select(
        "*", (F.sum("source_size").over(everything) * share).alias("total"), F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("cap").over(by_limit), F.lit(0.0)).alias("before"), F.coalesce(F.sum("weight").over(by_limit), F.lit(0)).alias("passed"),
    )
    stops = F.col("cap") <= (F.col("total") - F.col("before")) / (F.col("weights") - F.col("passed")) * F.col("weight")
    sources = sources.withColumn("stops", stops)
    given = F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0.0)).over(everything)
    left = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("stops"), F.col("cap")).otherwise((F.col("total") - given) / left * F.col("weight"))
    return sources.select("key", "source_size", "turn", target.alias("target"))


def position(done: Column, first: Column, last: Column) -> Column:
    """The time at which the share ``done`` of a demand is reached whose rate goes from ``first`` to ``last``."""
    reached = done * (first + last) / (first + F.sqrt(first * first + (last * last - first * first) * done))
    return F.when(done <= 0, 0.0).otherwise(F.least(reached, F.lit(1.0)))


def _source_key(source_col: str) -> Column:
    """A source for ordering, null as the last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(f"`{source_col}`").cast("string")), F.lit("1"))


def _size(text_col: str) -> Column:
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def _digest(identity: Column) -> Column:
    return F.md5(F.coalesce(identity.cast("string"), F.lit("")).cast("binary"))


def _buckets(base: DataFrame, weights: Sequence[int], share: float, most: float, rows_per_bucket: int) -> tuple[DataFrame, DataFrame]:
    """Distinct rows of id, key and size with their copies, digest and bucket; and what each bucket's words stand after.

    A bucket is a source's digests with the same first hex digits, about ``rows_per_bucket`` rows or fewer; there are
    few of them, one for so many rows and 256 for each source at least.
    """
    sizes = base.groupBy("id", "key", "size").agg(F.count(F.lit(1)).alias("copies"))
    digits = max(2, math.ceil(math.log(max(1, base.count()) / rows_per_bucket, 16)))
    sizes = sizes.withColumn("digest", _digest(F.col("id"))).withColumn("bucket", F.substring("digest", 1, digits))
    targets = source_targets(sizes, weights, share, most)
    buckets = sizes.groupBy("key", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("key", "bucket", "words", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("bucket_start"))
    return sizes, starts.join(targets, "key").withColumn("digits", F.lit(digits))


def in_training_order(
    docs: DataFrame, identity: Column, text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
    share: float = 1.5, most: float = 2.0, ramps: Sequence[tuple[float, float]] = RAMPS, rows_per_bucket: int = 1 << 15,
) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes a document of that ``identity``, text and source, in part counting as once.

    Rows travel once for each time they are taken. Where they are read the table of buckets tells about where they stand, and
    that decides the range of positions they are sent to; there a bucket's rows are counted up to their exact
    positions. A range's rows are in order; ranges follow each other but for a bucket that lies across a border,
    which is kept together. Equal rows stand one after another, in one range. Rows that have no words are never taken. Columns of
    ``docs`` come out as they are, whatever their names, and empty tables empty.
    """
    columns, names = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)], identity.alias("id"), _source_key(source_col).alias("key"), _size(text_col).alias("size"))
    base = cut(rows.select("id", "key", "size"), "sizes")
    starts = cut(_buckets(base, weights, share, most, rows_per_bucket)[1], "buckets")
    head = starts.first()
    if head is None:
        return docs.where("false")
    demand, begin = F.floor("target"), F.col("pass") * F.col("source_size")
    first, last = (in_turn([r[i] for r in ramps], F.col("turn")) for i in (0, 1))
    at = lambda words: position(F.try_divide(words, F.col("target")), first, last)
    parts = starts.withColumn("pass", F.explode(F.array(*[F.lit(n) for n in range(math.ceil(most))])))
    parts = parts.where(begin + F.col("bucket_start") < demand).withColumn("about", at(begin + F.col("bucket_start")))
    # ranges of about the same number of words; one row a bucket and pass, so one task is enough
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = F.sum("words").over(Window.orderBy("about", "key", "bucket", "pass"))
    parts = parts.withColumn("range", F.floor(F.least(F.lit(ranges - 1), (before - F.col("words")) * ranges / F.sum("words").over(Window.partitionBy(F.lit(1))))).cast("int"))
    parts = parts.select("key", "bucket", "pass", "range", "bucket_start", "source_size", "target", "turn")
    sent = rows.withColumn("digest", _digest(F.col("id"))).withColumn("bucket", F.substring("digest", 1, head["digits"])).where("size > 0")
    sent = sent.join(parts.hint("broadcast") if parts.count() <= _MOST_BROADCAST else parts, ["key", "bucket"]).repartitionByRange(ranges, "range")
    within = Window.partitionBy("range", "key", "bucket", "pass").orderBy("digest", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = begin + F.col("bucket_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    placed = sent.withColumn("start", start).where(F.col("start") < demand).withColumn("position", at(F.col("start")))
    return placed.sortWithinPartitions("range", "position", "id").select(*[F.col(n).alias(c) for c, n in zip(columns, names)])


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
    share: float = 1.5, most: float = 2.0, ramps: Sequence[tuple[float, float]] = RAMPS, rows_per_bucket: int = 1 << 15,
) -> DataFrame:
    """One row per document: ``id_col``, size, source_size, target, taken, position, passes.

    ``passes`` holds a struct of pass, position and words for each time the document is taken, the last
    one perhaps in part; ``position`` is the first of them, null for a document that is not taken. Rows
    are sorted by position over ranges. Sizes are words; a null text has none. A null source is a source
    of its own and the last; null and repeated ids are allowed, and equal rows stand one after another.
    Other columns are left out, whatever their names; an empty table gives no rows.
    """
    base = cut(docs.select(F.col(f"`{id_col}`").alias("id"), _source_key(source_col).alias("key"), _size(text_col).alias("size")), "sizes")
    sizes, starts = _buckets(base, weights, share, most, rows_per_bucket)
    words = F.sum(F.col("size") * F.col("copies"))
    within = Window.partitionBy("key", "bucket").orderBy("digest", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.join(starts, ["key", "bucket"]).withColumn("start", F.col("bucket_start") + F.coalesce(words.over(within), F.lit(0)))
    # equal rows stand one after another
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    placed = placed.withColumn("start", F.col("start") + (F.col("copy") - 1) * F.col("size"))

    demand = F.floor("target")
    first, last = (in_turn([r[i] for r in ramps], F.col("turn")) for i in (0, 1))

    def one_pass(number: Column) -> Column:
        begin = number * F.col("source_size") + F.col("start")
        taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), demand - begin))
        return F.struct(number.alias("pass"), position(F.try_divide(begin, F.col("target")), first, last).alias("position"), taken.alias("words"))

    passes = F.filter(F.array(*[one_pass(F.lit(n)) for n in range(math.ceil(most))]), lambda p: p["words"] > 0)
    placed = placed.select("id", "size", "source_size", "target", passes.alias("passes"))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda total, p: total + p["words"])
    placed = placed.select("id", "size", "source_size", "target", taken.alias("taken"), F.get("passes", F.lit(0))["position"].alias("position"), "passes")
    return placed.orderBy(F.col("position").asc_nulls_last(), "id").withColumnRenamed("id", id_col)


ORACLE = r"""
with base as (
  select doc_id, case when source is null then '1' else '0' || source end as key,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size, md5(coalesce(cast(doc_id as varchar), '')) as digest
  from documents),
s1 as (select key, cast(sum(size) as bigint) as source_size from base group by key),
s2 as (select *, [5, 2, 1][cast((row_number() over (order by key) - 1) % 3 as bigint) + 1] as weight, source_size * 2.0::double as cap from s1),
s3 as (select *, sum(source_size) over () * 1.5::double as total, sum(weight) over () as weights,
    coalesce(sum(cap) over (order by cap / weight, key rows between unbounded preceding and 1 preceding), 0) as before,
    coalesce(sum(weight) over (order by cap / weight, key rows between unbounded preceding and 1 preceding), 0) as passed from s2),
s4 as (select *, cap <= (total - before) / (weights - passed) * weight as stops from s3),
s5 as (select key, source_size, case when stops then cap else (total - sum(case when stops then cap else 0 end) over ())
    / sum(case when stops then 0 else weight end) over () * weight end as target from s4),
placed as (select base.*, s5.source_size, s5.target,
    coalesce(sum(size) over (partition by base.key order by digest, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start
  from base join s5 on base.key = s5.key)
select doc_id, size, source_size, target, cast(greatest(0, least(size, floor(target) - start))
    + greatest(0, least(size, floor(target) - source_size - start)) as bigint) as taken from placed
"""
