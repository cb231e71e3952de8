"""WARC archives: write, normalise, read back.

Writers stream their partition into one gzip stream per archive, as crawlers that compress whole
files do. The normaliser inflates such a stream once, front to back, and rewrites every record as a
gzip member of its own; the sidecar index holds each member's offset and length, so that later
reads seek to single records. Equal payloads of at least `min_bytes` bytes are stored once: the
smallest page_id is a response, the others are revisits that refer to it. Only digests that occur
twice are joined to the pages, and they are broadcast only while counted to be few.

Cases: a null html is an empty payload and a null url is left out; line ends are taken out of URLs; extra columns of
pages are left out whatever their names; a null page_id sorts after all
others and is written as an empty id; rows that repeat the smallest page_id with the same payload
are all responses; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from admill.llm.common import join_checked, materialise, require, scratch
from admill.llm.files import opened, written

LEVEL, CHUNK = 6, 1 << 20
_GZIP = 16 + zlib.MAX_WBITS
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = "archive string, position long, size long, page_id long, record_type string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one WARC/1.1 record; a revisit has no payload but its digest and length."""
    block = _HTTP if revisit else _HTTP + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": None if url is None else url.replace("\r", "").replace("\n", ""),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Payload-Length": str(len(payload)),
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "WARC-Refers-To": _urn(refers_to) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream."""
    held = bytearray()
    wanted = -1
    for chunk in chunks:
        held += chunk
        while True:
            if wanted < 0:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = bytes(held[:end]).lower()
                size = head.split(b"\r\ncontent-length: ", 1)[1].split(b"\r\n", 1)[0]
                wanted = end + 4 + int(size) + 4
            if len(held) < wanted:
                break
            yield bytes(held[:wanted])
            del held[:wanted]
            wanted = -1
    if held:
        raise ValueError(f"the archive ends within a record: {len(held)} bytes are left")


def inflated(uri: str) -> Iterator[bytes]:
    """A gzip file front to back, at most `CHUNK` bytes at a time however well they are compressed; its members, one or many, join into one stream."""
    with opened(uri) as f:
        stream = zlib.decompressobj(_GZIP)
        while data := f.read(CHUNK):
            more = True
            while more:
                out = stream.decompress(data, CHUNK)
                if out:
                    yield out
                data = stream.unused_data if stream.eof else stream.unconsumed_tail
                more = bool(data) or (not stream.eof and len(out) == CHUNK)
                if stream.eof:
                    stream = zlib.decompressobj(_GZIP)
        yield stream.flush()


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages with refers_to: the smallest page_id of equal payloads where that is another row's."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = require(pages, "page_id", "url", "html").select("page_id", "url", "html", F.sha1(body).alias("_sha"), F.octet_length(body).alias("_size"))
    shared = keyed.filter(F.col("_size") >= min_bytes).groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    shared = materialise(shared.select("_sha", "_first"), "payloads")
    first = F.when(F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first"))
    return join_checked(keyed, shared, "_sha", "left").select("page_id", "url", "html", first.alias("refers_to"))


def write_monolithic(rows: DataFrame, folder: str) -> DataFrame:
    """Writes an archive per partition, each one gzip stream; a row per archive."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        uri = f"{folder}/part-{task.partitionId():06d}.warc.gz"
        n, stream = 0, zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
        with written(uri, task.taskAttemptId()) as out:
            for batch in batches:
                for page_id, url, html, refers_to in batch.itertuples(index=False):
                    ids = [None if pd.isna(x) else int(x) for x in (page_id, refers_to)]
                    payload = (html or "").encode()
                    out.write(stream.compress(record(ids[0], url, payload, ids[1], ids[1] is not None)))
                    n += 1
            out.write(stream.flush())
        if n:
            yield pd.DataFrame({"archive": [uri], "records": [n]})

    ids = [F.col(c).cast("string").alias(c) if c in ("page_id", "refers_to") else F.col(c) for c in ("page_id", "url", "html", "refers_to")]
    return materialise(rows.select(*ids).mapInPandas(write, "archive string, records long"), "archives")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive record by record, writes its sidecar, and returns the index of all."""

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for source in batch["archive"]:
                uri = f"{folder}/{source.rpartition('/')[2]}"
                rows, position = [], 0
                with written(uri, attempt) as out:
                    for data in split_records(inflated(source)):
                        fields, _ = parse(data)
                        stream = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
                        member = stream.compress(data) + stream.flush()
                        out.write(member)
                        page = (fields["warc-record-id"] or "").removeprefix("<urn:page:").removesuffix(">")
                        rows.append((uri, position, len(member), page, fields["warc-type"]))
                        position += len(member)
                index = pd.DataFrame(rows, columns=["archive", "position", "size", "page_id", "record_type"])
                with written(f"{uri}.idx", attempt) as out:
                    out.write(index.drop(columns="archive").to_csv(index=False).encode())
                yield index

    spread = archives.repartition(max(1, archives.count()), "archive")
    text_id = INDEX.replace("page_id long", "page_id string")
    rows = spread.mapInPandas(rewrite, text_id)
    return materialise(rows.withColumn("page_id", F.expr("try_cast(page_id AS long)")), "warc-index")


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the index rows point at, read member by member; digests are checked."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for archive, group in batch.sort_values(["archive", "position"]).groupby("archive"):
                with opened(archive) as f:
                    for position, size in zip(group["position"], group["size"]):
                        f.seek(int(position))
                        fields, block = parse(zlib.decompress(f.read(int(size)), _GZIP))
                        payload = block.split(b"\r\n\r\n", 1)[1]
                        revisit = fields["warc-type"] == "revisit"
                        told = fields["warc-payload-digest"].removeprefix("sha1:")
                        if not revisit and told != digest(payload):
                            raise ValueError(f"{archive} at {position}: the payload doesn't match its digest")
                        length = int(fields["warc-payload-length"]) if revisit else len(payload)
                        refers_to = fields.get("warc-refers-to") if revisit else None
                        ids = [None if x is None else str(x) for x in (_page(fields["warc-record-id"]), _page(refers_to))]
                        rows.append((ids[0], fields.get("warc-target-uri"), length, told, fields["warc-type"], ids[1], payload if payloads and not revisit else None))
            yield pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    text_ids = RECORD.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string")
    rows = index.select("archive", "position", "size").mapInPandas(read, text_ids)
    return rows.withColumns({c: F.expr(f"try_cast({c} AS long)") for c in ("page_id", "refers_to")})


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of all archives in a folder, from their sidecars alone."""
    rows = spark.read.schema("position long, size long, page_id string, record_type string").option("header", True).csv(f"{folder}/*.idx")
    archive = F.regexp_replace(F.regexp_replace(F.input_file_name(), "^file:/+", "file:///"), r"\.idx$", "")
    return rows.select(archive.alias("archive"), "position", "size", F.expr("try_cast(page_id AS long)").alias("page_id"), "record_type")


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes pages as archives below folder and returns the normalised archives' index."""
    folder = folder or scratch(pages.sparkSession, "warc")
    return normalise(write_monolithic(with_revisits(pages, min_bytes), f"{folder}/monolithic"), f"{folder}/records")


def archived_pages(pages: DataFrame) -> DataFrame:
    """A row per page, as read back from the archives."""
    found = read_records(archive_pages(pages), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
