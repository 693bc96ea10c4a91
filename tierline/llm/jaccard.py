"""Similarity join of word shingles by PartEnum signatures, and its connected components.

Sets are dealt into size bands, each twice as wide as the one before; a set just under a band's
lower end is a guest of that band too, so two similar sets always meet in one. In a band the domain of
shingles is cut into pairs of partitions, and of each pair both subsets of one partition are
enumerated: a signature is a hash of the set's shingles in one partition. Partitions are about a quarter more than
the shingles in which the band's largest sets may differ, so a signature of a set of 128 shingles or more stands for two
or three of them on average, and sets that share a small part of their shingles rarely share one. Two sets that differ in at most
``d`` shingles differ in at most ``d`` signatures. So if each keeps the first ``d + 1`` of its non-empty
signatures in one common order, similar sets share a kept one. The order puts signatures that a sample
finds frequent last, so texts that only share a common passage rarely meet. A set with ``d`` signatures or
fewer keeps them all, and one more that such sets of its band share.

Sets that share a signature are candidates. They are first compared with one member of each signature's
group, then, across what is not connected by then, with each other. Before a comparison the parities of
``PARITIES`` classes of shingles are held against each other: sets differ in at least as many shingles as
parities, so too many different ones rule a pair out. What is left is compared shingle by shingle. Shingles
and equal sets are told by 64-bit hashes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import by_size, cut, small_batches, text_of

SHINGLE = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
_BAND = 2
#: A band has as many partitions at least, and a pair's hot side is dealt over as many tasks at most.
_LEAST_PARTITIONS = 64
_SALTS = 64
#: Bytes of text that a worker turns into sets at a time.
_BLOCK = 1 << 17
PARITIES = 1024
_WORDS = PARITIES // 64
_SEPARATOR = np.isin(np.arange(256), [32, *range(9, 14)])
_RANDOM = np.random.Generator(np.random.PCG64(20))
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _powers(base: int, length: int) -> np.ndarray:
    powers = np.full(length, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts, A to Z lower-cased, and where each text's words begin and end."""
    joined = b"\n".join(texts).lower() + b"\n"
    data = np.frombuffer(joined, np.uint8)
    space = _SEPARATOR[data]
    change = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = change[::2], change[1::2]
    length = 1 << max(18, len(data).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers(_BASE, length)[: len(data)], dtype=np.uint64)])
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, length)[starts]
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    return mix(hashes ^ (ends - starts).astype(np.uint64)), np.searchsorted(starts, edges)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; fewer words than a shingle has are one, none give none."""
    words, edges = word_hashes(texts)
    count = max(0, len(words) - SHINGLE + 1)
    sums = np.zeros(count, np.uint64)
    for i in range(SHINGLE):
        sums += words[i : count + i] * _PLACES[i]
    sums = mix(sums)
    sets = []
    for start, end in zip(edges, edges[1:]):
        if end - start >= SHINGLE:
            sets.append(np.unique(sums[start : end - SHINGLE + 1]))
        elif end > start:
            short = words[start:end] * _PLACES[: end - start]
            sets.append(mix(short.sum(dtype=np.uint64, keepdims=True) + _PLACES[SHINGLE] * np.uint64(end - start)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_hash(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    total = mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles)))
    return int(total.astype(np.int64)[0])


def parities(shingles: np.ndarray, classes: int = PARITIES) -> np.ndarray:
    """Whether a set has an odd number of shingles in each class, as 64-bit words; ``classes`` is a power of two."""
    odd = np.bincount((mix(shingles) >> np.uint64(24)).astype(np.int64) % classes, minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def fine_parities(shingles: np.ndarray) -> np.ndarray:
    """Parities of at least two classes a shingle."""
    return parities(shingles, max(64, 1 << (2 * len(shingles) - 1).bit_length()))


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """In how many parities two sets differ; the finer ones are folded to as many classes as the others have."""
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum())


def most_apart(a: int, b: int) -> int:
    """In how many shingles similar sets of these sizes differ at most."""
    return a + b + 2 * (-PERCENT * (a + b) // (100 + PERCENT))


def furthest(size: int) -> int:
    """The most shingles in which a set of ``size`` differs from a similar one: both sizes less twice the overlap."""
    return (100 - PERCENT) * (size + 100 * size // PERCENT) // (100 + PERCENT)


def bands(size: int) -> list[int]:
    """The band of a set, and the next one if a set there can be similar."""
    own = 0
    while _BAND ** (own + 1) <= size:
        own += 1
    return [own, own + 1] if 100 * size >= PERCENT * _BAND ** (own + 1) else [own]


def partitions(band: int) -> int:
    """Into how many partitions a band's domain is cut: even, and enough for its largest sets to keep what they must."""
    return max(_LEAST_PARTITIONS, 2 * -(-5 * furthest(_BAND ** (band + 1)) // 8))


def signatures(shingles: np.ndarray, band: int) -> np.ndarray:
    """The hash of what a set has in each partition of a band's domain where it has anything."""
    place = mix(shingles + np.uint64(band)) % np.uint64(partitions(band))
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    content = np.add.reduceat(mix(shingles)[order], first)
    return mix(content ^ mix(place[first] * np.uint64(64) + np.uint64(band + 1)))


def kept_signatures(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The signatures under which a set meets all similar ones; ``frequent`` is sorted."""
    kept = []
    for band in bands(len(shingles)):
        all_of = np.sort(signatures(shingles, band))
        most = furthest(len(shingles)) + 1
        if len(all_of) < most:
            kept += [all_of, mix(np.array([band + 1], np.uint64) * _PLACES[0])]
            continue
        if len(frequent):
            late = frequent[np.minimum(np.searchsorted(frequent, all_of), len(frequent) - 1)] == all_of
            all_of = np.concatenate([all_of[~late], all_of[late]])
        kept.append(all_of[:most])
    return np.concatenate(kept)


def _texts(block: pa.RecordBatch) -> list[bytes]:
    return block.column("text").cast(pa.binary()).to_pylist()


def summaries(rows: DataFrame) -> DataFrame:
    """id, check, n, node, odd for each row (id, check, text): the size, hash and parities of its set; null if empty."""

    def run(batches):
        for block in by_size(batches, "text", _BLOCK):
            sets = shingle_sets(_texts(block))
            columns = [
                pa.array([len(s) for s in sets], pa.int64()), pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([parities(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("check"), *columns], ["id", "check", "n", "node", "odd"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "check", "text").mapInArrow(run, f"id {kind}, check long, n long, node long, odd array<long>")


def frequent_signatures(rows: DataFrame, sample_rows: int, share: float) -> np.ndarray:
    """Signatures of at least ``share`` of about ``sample_rows`` rows picked by hash, sorted.

    They only order signatures, so the sample has no part in what is found. There are at most
    1 / ``share`` of them for each signature that an average row has.
    """
    total = rows.count()
    part = min(1.0, sample_rows / max(1, total))

    def run(batches):
        for block in by_size(batches, "text", _BLOCK):
            found = [signatures(s, b) for s in shingle_sets(_texts(block)) if len(s) for b in bands(len(s))]
            values, counts = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts, pa.int64())], ["signature", "n"])

    sample = rows.where(F.pmod(F.xxhash64("check", "id"), F.lit(1 << 20)) < int(part * (1 << 20))).select("text")
    counted = sample.mapInArrow(run, "signature long, n long").groupBy("signature").agg(F.sum("n").alias("n"))
    least = max(8, int(share * part * total))
    with small_batches(rows.sparkSession):
        found = counted.where(F.col("n") >= least).select("signature").toArrow().column(0).to_numpy()
    return np.sort(found.astype(np.int64).astype(np.uint64))


def emitted(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """signature and node, for every set; a task passes over sets that it met before."""
    held = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        met: set[int] = set()
        for block in by_size(batches, "text", _BLOCK):
            keys, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for own in shingle_sets(_texts(block)):
                node = set_hash(own) if len(own) else None
                if node is None or node in met:
                    continue
                if len(met) < 1 << 20:
                    met.add(node)
                keys.append(kept_signatures(own, held.value))
                nodes.append(np.full(len(keys[-1]), node, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(nodes))], ["signature", "node"])

    return rows.select("text").mapInArrow(run, "signature long, node long")


def can_be_similar(a: str, b: str) -> Column:
    """Whether sizes and parities (``n`` and ``odd`` after the given prefixes) leave two sets a chance."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    differ = sum((F.bit_count(F.col(f"{a}odd{i}").bitwiseXOR(F.col(f"{b}odd{i}"))) for i in range(_WORDS)), F.lit(0))
    least_overlap = F.ceil(F.lit(PERCENT) * (n + m) / (100 + PERCENT))
    return (F.greatest(n, m) * PERCENT <= F.least(n, m) * 100) & (differ <= n + m - 2 * least_overlap)


def _named(nodes: DataFrame, key: str, prefix: str) -> DataFrame:
    """Size and parities of nodes, under names for one side of a pair."""
    return nodes.select(F.col("node").alias(key), F.col("n").alias(f"{prefix}n"), *[F.get("odd", F.lit(i)).alias(f"{prefix}odd{i}") for i in range(_WORDS)])


def _bits_of(checks: DataFrame, bits: int) -> np.ndarray:
    """A bit for each ``check``, by its last digits: a summary of fixed size, whatever the number of rows."""
    place = F.pmod(F.col("check"), F.lit(bits))
    words = checks.groupBy(F.floor(place / 64).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(check, {bits}) % 64 as int))")).alias("marks"))
    found = words.toArrow()
    marks = np.zeros(bits // 64, np.int64)
    marks[found.column("word").to_numpy()] = found.column("marks").to_numpy()
    return marks.view(np.uint64)


def _marked(rows: DataFrame, marks: np.ndarray) -> DataFrame:
    """The rows whose check has its bit set, so that few others are shuffled."""
    held = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        marks = held.value
        for batch in batches:
            place = batch.column("check").to_numpy() % (64 * len(marks))
            bit = (marks[place // 64] >> (place % 64).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(bit.astype(bool)))

    return rows.mapInArrow(run, rows.schema)


def _join_u(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """``pairs`` (u, v) joined with ``held`` (u and more). A centre is the u of many pairs, so its row is copied to
    salts, by which its pairs are dealt."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(_SALTS)))
    copies = pairs.select("u", "salt").distinct().join(held, "u")
    return pairs.join(copies, ["u", "salt"]).drop("salt")


def _with_sets(pairs: DataFrame, held: DataFrame, column: str) -> DataFrame:
    """What ``held`` has in ``column`` for both sides of pairs, as a and b."""
    joined = _join_u(pairs, held.select(F.col("node").alias("u"), F.col(column).alias("a")))
    return joined.join(held.select(F.col("node").alias("v"), F.col(column).alias("b")), "v").select("u", "v", "a", "b")


def links_among(pairs: DataFrame, rows: DataFrame, nodes: DataFrame, bits: int = 1 << 22) -> DataFrame:
    """Those of ``pairs`` (u, v) that are similar, compared shingle by shingle.

    Only the texts in question are read again, one for each set. Parities as fine as the sets rule out
    most pairs that are not similar before whole sets are moved.
    """
    asked = pairs.select("u").union(pairs.select("v")).distinct().withColumnRenamed("u", "node")
    wanted = cut(asked.join(nodes.select("node", "rep", "rep_check"), "node"), "wanted")
    some = _marked(rows, _bits_of(wanted.select(F.col("rep_check").alias("check")), bits))
    found = some.join(wanted, some["id"].eqNullSafe(wanted["rep"]) & (some["check"] == wanted["rep_check"])).select("node", "text")
    # the shuffle stands between the two Python steps, which in one stage would take two workers for each task
    found = found.dropDuplicates(["node"])

    def sets(batches):
        for block in by_size(batches, "text", _BLOCK):
            own = shingle_sets(_texts(block))
            columns = [pa.array([f(s).tobytes() for s in own], pa.binary()) for f in (fine_parities, np.asarray)]
            columns.insert(0, pa.array([len(s) for s in own], pa.int64()))
            yield pa.RecordBatch.from_arrays([block.column("node"), *columns], ["node", "n", "odd", "shingles"])

    schema = "node long, n long, odd binary, shingles binary"
    held = cut(found.mapInArrow(sets, schema), "sets").withColumn("sized", F.struct("n", "odd"))

    def chosen(is_kept):
        def run(batches):
            for block in batches if is_kept is close else by_size(batches, "a", 1 << 22):
                kept = [is_kept(a, b) for a, b in zip(block.column("a").to_pylist(), block.column("b").to_pylist())]
                yield block.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

        return run

    def close(a, b):
        return differing(np.frombuffer(a["odd"], "<i8"), np.frombuffer(b["odd"], "<i8")) <= most_apart(a["n"], b["n"])

    def similar(a, b):
        a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * shared >= PERCENT * (len(a) + len(b) - shared)

    near = cut(_with_sets(pairs, held, "sized").mapInArrow(chosen(close), "u long, v long"), "near")
    return cut(_with_sets(near, held, "shingles").mapInArrow(chosen(similar), "u long, v long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node that it is connected to, for every node of ``edges`` (u, v) but the roots.

    Large-star and small-star steps in turn until every node hangs on a root; each turn's edges are written
    to the shared folder.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _is_star(edges):
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).union(edges.select("v", "u"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = cut(small.distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _is_star(edges: DataFrame) -> bool:
    """Whether no node has two edges to smaller ones, and none that it hangs on hangs on another."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return seen.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def joined_components(roots: DataFrame, more: DataFrame) -> DataFrame:
    """Components of ``roots`` (node, root) with further links (u, v): only roots are connected anew."""
    found = more.select("u", "v")
    for side in ("u", "v"):
        of = roots.select(F.col("node").alias(side), F.col("root").alias("r"))
        found = found.join(of, side, "left").withColumn(side, F.coalesce("r", side)).drop("r")
    upper = cut(components(found), "roots")
    moved = roots.join(upper.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return upper.union(moved.select("node", F.coalesce("top", "root").alias("root")))


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 1 << 15, share: float = 1 / 4096
) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id, the smallest id that links lead to.

    A null or empty text, or one without words, has no shingles and no links; its component is its own
    id. Equal sets are linked. Repeated rows and ids are allowed; null ids are never a component's
    smallest unless it has no other. Other columns are left out, whatever their names; an empty table
    gives no rows.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("check"), text.alias("text"))
    found = cut(summaries(rows), "summaries")
    nodes = found.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("id").alias("least_id"), F.min("n").alias("n"), F.min(F.struct("id", "check")).alias("rep"), F.min("odd").alias("odd")
    )
    nodes = cut(nodes.select("node", "least_id", "n", "odd", F.col("rep.id").alias("rep"), F.col("rep.check").alias("rep_check")), "nodes")

    # signatures of more than one set
    group = Window.partitionBy("signature")
    keys = emitted(rows, frequent_signatures(rows, sample_rows, share))
    keys = keys.withColumns({"low": F.min("node").over(group), "high": F.max("node").over(group), "size": F.count("node").over(group)})
    keys = cut(keys.where("low <> high").select("signature", "node", "size").dropDuplicates(["signature", "node"]), "keys")

    # the member that meets most others is the likeliest centre of its group
    weights = keys.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = keys.select("signature", "node").join(weights, "node")
    centre = F.max(F.struct("weight", "node")).over(group)["node"]
    tried = weighed.select(centre.alias("u"), F.col("node").alias("v")).where("u <> v").distinct()
    tried = _join_u(cut(tried, "centres"), _named(nodes, "u", "u_")).join(_named(nodes, "v", "v_"), "v").where(can_be_similar("u_", "v_"))
    tried = cut(tried.select("u", "v"), "pairs")
    links = links_among(tried, rows, nodes)

    # signatures whose sets are not all connected by that
    roots = components(links)
    grouped = keys.select("signature", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    grouped = grouped.withColumns({"low": F.min("root").over(group), "high": F.max("root").over(group)}).where("low <> high")
    grouped = cut(grouped.select("signature", "node", "root"), "open").join(_named(nodes, "node", ""), "node")
    left, right = (grouped.select("signature", *[F.col(c).alias(f"{side}_{c}") for c in grouped.columns if c != "signature"]) for side in "ab")
    rest = left.join(right, (left["signature"] == right["signature"]) & (F.col("a_root") < F.col("b_root")) & can_be_similar("a_", "b_"))
    rest = rest.select(F.col("a_node").alias("u"), F.col("b_node").alias("v")).distinct()
    rest = rest.join(tried, ["u", "v"], "left_anti").join(tried.select(F.col("u").alias("v"), F.col("v").alias("u")), ["u", "v"], "left_anti")
    more = links_among(cut(rest, "rest"), rows, nodes)
    roots = joined_components(roots, more)

    members = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = members.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = members.join(least, "root").select("node", "component_id")
    out = found.select("id", "n", "node").join(members, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
