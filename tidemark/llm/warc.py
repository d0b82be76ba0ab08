"""WARC archives in which equal payloads are stored once.

1. Only headers (page id, digest, length) are shuffled by payload digest. Of the pages with one
   payload of at least ``LEAST_BYTES`` bytes, the one with the smallest id is the response; the
   others become revisits of it. Smaller payloads are always stored.
2. The archives are written where the pages are read: every task writes its pages, each record
   with fresh headers. Record ids are derived from page id and digest, so a rerun, or the second
   attempt of a lost task, writes the same records.
3. Reading parses the records by their lengths and joins revisits to their responses.

Archives are gzip files, written and committed by Spark: of at most ``FILE_RECORDS`` records, fewer where
records are large, so that an archive holds some ``FILE_BYTES`` of average records. They are read as a
stream, one record in memory at a time and ``BATCH_RECORDS`` rows of headers.

Defined cases: a null payload is empty; a null address becomes ``urn:page:<id>``. Pages equal in id
and payload are all responses. A null id is never a response others refer to, unless all ids of
the payload are null; then all are responses. Extra columns are ignored. An empty table makes an
archive without records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import hot_keys, skew_join
from tidemark.session import stage

LEAST_BYTES = 100
FILE_RECORDS = 4096
FILE_BYTES = 256 << 20
BATCH_RECORDS = 1024
DATE = "2024-01-01T00:00:00Z"

_EOL = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARSED = (
    "page_id long, record_id string, refers_to_id string, record_type string, "
    "payload_digest string, stored_bytes long, intact boolean"
)


def _record_id(page: Column, digest: Column) -> Column:
    h = F.sha2(F.concat_ws(":", page.cast("string"), digest), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload another page stores."""
    heads = pages.select("page_id", "digest", "bytes").where(F.col("bytes") >= LEAST_BYTES)
    groups = (
        heads.groupBy("digest", "bytes")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("refers_to"))
        .where("n > 1 and refers_to is not null")
    )
    groups = stage(groups, "warc-groups")
    rows = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = hot_keys(groups, ["digest", "bytes"], "n", rows)
    found = skew_join(heads, groups.drop("n"), ["digest", "bytes"], "inner", hot)
    other = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return found.where(other).select("page_id", "digest", "refers_to").distinct()


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> None:
    """Write one record per page to gzip archives under ``path``."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    own = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    # staged, so that the planner knows whether the payloads have to move at all
    again = stage(revisits(own), "warc-revisits").withColumnsRenamed(
        {"page_id": "r_id", "digest": "r_digest"}
    )
    same = (F.col("digest") == F.col("r_digest")) & F.col("page_id").eqNullSafe(F.col("r_id"))
    rows = own.join(again, same, "left")
    mean = own.agg(F.avg("bytes")).first()[0] or 0
    file_records = int(min(FILE_RECORDS, max(1, FILE_BYTES // (mean + 1))))
    is_revisit = F.col("refers_to").isNotNull()
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    address = F.coalesce(
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), page)
    )
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), address),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("X-Page-Id: "), page),
        F.when(
            is_revisit,
            F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to"), F.col("digest"))),
        ),
        F.when(is_revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(
            F.lit("Content-Length: "),
            (F.when(is_revisit, 0).otherwise(F.col("bytes")) + len(_HTTP)).cast("string"),
        ),
    ]
    block = F.concat(F.lit(_HTTP), F.when(is_revisit, "").otherwise(F.col("payload")))
    head = F.concat_ws(_EOL, F.lit("WARC/1.1"), *lines)
    record = F.concat(head, F.lit(_EOL * 2), block, F.lit(_EOL))
    (
        rows.select(record.alias("value"))
        .write.option("lineSep", _EOL)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", file_records)
        .text(path)
    )


def warc_records(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an unpacked archive, each found by the length of the one before."""
    while version := archive.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record where {version[:40]!r} stands")
        lines = iter(archive.readline, b"\r\n")
        headers = dict(line.decode().rstrip("\r\n").split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        block = archive.read(length)
        if len(block) != length or archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers['WARC-Record-ID']} has a wrong length")
        yield headers, block


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PARSED.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.bool_()]
    schema = pa.schema(list(zip(names, kinds)))
    def row(head: dict[str, str], block: bytes) -> dict:
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        stored = head["WARC-Type"] == "response"
        return {
            "page_id": int(head["X-Page-Id"]) if head.get("X-Page-Id") else None,
            "record_id": head["WARC-Record-ID"],
            "refers_to_id": head.get("WARC-Refers-To"),
            "record_type": head["WARC-Type"],
            "payload_digest": digest,
            "stored_bytes": len(payload) if stored else None,
            "intact": hashlib.sha256(payload).hexdigest() == digest if stored else None,
        }

    for batch in batches:
        for content in batch.column(0):
            with gzip.open(io.BytesIO(content.as_py())) as archive:
                rows = (row(*record) for record in warc_records(archive))
                while part := list(itertools.islice(rows, BATCH_RECORDS)):
                    yield pa.RecordBatch.from_pylist(part, schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of every record.

    Length and target of a revisit come from the response it refers to; ``intact`` tells whether
    the stored payload has the digest of its header.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    records = stage(files.select("content").mapInArrow(_parse, PARSED), "warc-records")
    stored = records.where("record_type = 'response'").select(
        "page_id", F.col("stored_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.lit(None).cast("long").alias("refers_to"), "intact",
    )
    again = records.where("record_type = 'revisit'").select(
        "page_id", "payload_digest", "record_type", F.col("refers_to_id").alias("id")
    )
    per_target = stage(again.groupBy("id").agg(F.count("*").alias("n")), "warc-targets")
    rows = per_target.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    targets = (
        records.where("record_type = 'response'")
        .select(
            F.col("record_id").alias("id"), F.col("page_id").alias("refers_to"),
            F.col("stored_bytes").alias("payload_bytes"), "intact",
        )
        .join(per_target.select("id"), "id", "left_semi")
        .dropDuplicates(["id"])
    )
    resolved = skew_join(again, targets, ["id"], "left", hot_keys(per_target, ["id"], "n", rows))
    return stored.unionByName(resolved.select(stored.columns))
