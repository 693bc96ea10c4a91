"""Archives of web records with each payload stored once, under its digest.

An archive is two Parquet folders: ``payloads`` has digest, length and the compressed bytes, once for
each distinct payload; ``headers`` has every record's header bytes exactly as written, and the digest.
Original records come back by a join on the digest, and every payload read is checked against it.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import by_size

_END = "\r\n"


def _compressed(batches):
    for block in by_size(batches, "payload", 1 << 23):
        rows = block.column("payload").to_pylist()
        columns = (
            [hashlib.sha256(p).hexdigest() for p in rows], [len(p) for p in rows], [hashlib.blake2b(p, digest_size=16).digest() for p in rows],
            [zlib.compress(p, 1) for p in rows],
        )
        names = ["digest", "payload_bytes", "second", "packed"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.binary()))], names)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_END))


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 100,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record for each row; of equal payloads of at least ``least`` bytes all but one are revisits.

    That one is the row with the smallest id (of repeated rows with that id, one); null ids come last. A
    null payload is empty; a null url has no line. Other columns are left out, whatever their names.
    Payloads are equal if their SHA-256 is; a second digest and the length must then agree or the
    write fails. An empty table gives an empty archive.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    packed = pages.select(payload.alias("payload")).mapInArrow(_compressed, "digest string, payload_bytes long, second binary, packed binary")
    once = packed.groupBy("digest").agg(
        F.first("packed").alias("packed"), *[f(c).alias(f"{n}_{c}") for c in ("payload_bytes", "second") for n, f in (("least", F.min), ("most", F.max))]
    )
    agree = (F.col("least_payload_bytes") == F.col("most_payload_bytes")) & (F.col("least_second") == F.col("most_second"))
    clash = F.raise_error(F.concat(F.lit("different payloads under digest "), "digest")).cast("long")
    once = once.select("digest", F.when(agree, F.col("least_payload_bytes")).otherwise(clash).alias("payload_bytes"), "packed")
    once.write.option("compression", "none").parquet(f"{path}/payloads")

    rows = pages.select(
        F.col(f"`{id_col}`").cast("string").alias("name"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n"),
    )
    rows = rows.groupBy("digest", "n", "id", "name", "url").agg(F.count(F.lit(1)).alias("copies"))
    firsts = rows.where(F.col("n") >= least).groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "url")).alias("f"))
    firsts = firsts.select("digest", F.col("f.id").alias("first_id"), F.col("f.url").alias("first_url"))
    rows = rows.join(firsts, "digest", "left")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    leads = (F.col("copy") == 1) & F.col("id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    kind = F.when((F.col("n") < least) | leads, "response").otherwise("revisit")
    rows = rows.withColumn("kind", kind)

    def name(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.url_encode(F.coalesce(c, F.lit(""))))

    url = F.translate(F.col("url"), "\r\n", "")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("n"), F.lit(_END + _END))
    length = F.octet_length(http) + F.when(F.col("kind") == "response", F.col("n")).otherwise(0)
    header = F.concat(
        F.lit(f"WARC/1.1{_END}"), _line("WARC-Type", F.col("kind")),
        _line("WARC-Record-ID", F.concat(name(F.col("name")), F.lit(":"), F.xxhash64("url").cast("string"), F.lit(":"), F.col("copy"), F.lit(">"))),
        _line("WARC-Date", F.lit(date)), F.when(F.col("url").isNull(), "").otherwise(_line("WARC-Target-URI", url)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(F.col("kind") == "response", "").otherwise(
            F.concat(
                _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                _line("WARC-Refers-To", F.concat(name(F.col("first_id").cast("string")), F.lit(">"))),
            )
        ),
        _line("Content-Type", F.lit("application/http;msgtype=response")), _line("Content-Length", length), F.lit(_END), http,
    )
    rows.select("digest", header.cast("binary").alias("header")).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """The records of an archive, from their bytes: record_id, page, url, record_type, refers_to, payload_bytes,
    payload_digest, record_bytes, and with ``whole`` the payload and the record as written.

    ``page`` and ``refers_to`` are the ids as text, null where they were null. A payload that is missing
    or does not have its digest and length fails the read.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").withColumn("stored", F.lit(True))
    joined = headers.join(payloads, "digest", "left")
    text = ["record_id", "page", "url", "record_type", "refers_to", "payload_digest"]
    fields = [(n, pa.string()) for n in text] + [("payload_bytes", pa.int64()), ("record_bytes", pa.int64())]
    fields += [("payload", pa.binary()), ("record", pa.binary())] if whole else []
    ddl = ", ".join(f"{n} {'string' if t == pa.string() else 'long' if t == pa.int64() else 'binary'}" for n, t in fields)

    def parse(batches):
        from urllib.parse import unquote_plus

        def page(name: str | None) -> str | None:
            return unquote_plus(name.strip("<>").split(":")[2]) or None if name else None

        for block in by_size(batches, "packed", 1 << 22):
            out = []
            for header, packed, length, digest in zip(*(block.column(n).to_pylist() for n in ("header", "packed", "payload_bytes", "digest"))):
                lines = header.split(b"\r\n\r\n", 1)[0].decode().split(_END)
                named = dict(line.split(": ", 1) for line in lines[1:])
                if packed is None:
                    raise ValueError(f"no payload under digest {digest}")
                payload = zlib.decompress(packed)
                found = hashlib.sha256(payload).hexdigest()
                if f"sha256:{found}" != named["WARC-Payload-Digest"] or len(payload) != length:
                    raise ValueError(f"the payload under digest {digest} has digest {found}")
                block_bytes = header.split(b"\r\n\r\n", 1)[1] + (payload if named["WARC-Type"] == "response" else b"")
                if len(block_bytes) != int(named["Content-Length"]):
                    raise ValueError(f"record {named['WARC-Record-ID']} is {len(block_bytes)} bytes long")
                record = header.split(b"\r\n\r\n", 1)[0] + b"\r\n\r\n" + block_bytes + b"\r\n\r\n"
                row = (
                    named["WARC-Record-ID"], page(named["WARC-Record-ID"]), named.get("WARC-Target-URI"), named["WARC-Type"],
                    page(named.get("WARC-Refers-To")), found, len(payload), len(record),
                )
                out.append((*row, payload, record) if whole else row)
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    return joined.select("header", "packed", "payload_bytes", "digest").mapInArrow(parse, ddl)
