"""Legacy ARC archives to WARC: version-specific header lines are parsed, WARC records synthesised.

ARC files hold records one after another, a line feed behind each. A record is a header line and
as many bytes as the line declares. The first record of a file, ``filedesc:``, names the version:

    1   URL IP-address Archive-date Content-type Archive-length
    2   URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length

The converter makes for each record a WARC record id (a name-based UUID of its address, date and
digest), an ISO timestamp from the 14-digit date, the record type and the block and payload
digests. Of records with equal payloads the one with the smallest key stays a response; the others
are written as revisits, with the response's HTTP header alone as their block. Payloads shorter
than a given length are never revisits.

All files are written by Spark's text writer, whose line separator is just what stands between
records, and read as binary files, so any store will do.
"""

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelworks.functions.logic import quoted
from parcelworks.llm.ordering import new_folder
from parcelworks.llm.scan import batch_of, slices, text_list

COLUMNS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
KEY_HEADER = "X-Archive-Key"
DATE = "20240101000000"
NO_ADDRESS = "0.0.0.0"
BETWEEN_WARC = "\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _address(url: str | None) -> str:
    """An address without white space, which would end its field in the header line."""
    if not url or not url.strip():
        return "unknown:"
    return re.sub(r"\s", lambda m: "".join(f"%{byte:02X}" for byte in m[0].encode("utf-8")), url)


def arc_record(version: int, url: str, kind: str, block: bytes, date: str = DATE) -> bytes:
    """Header line and block of one ARC record."""
    if version == 1:
        line = f"{url} {NO_ADDRESS} {date} {kind} {len(block)}\n"
    else:
        line = f"{url} {NO_ADDRESS} {date} {kind} 200 {digest_of(block)} - 0 - {len(block)}\n"
    return line.encode("utf-8") + block


def arc_version_record(version: int) -> bytes:
    block = f"{version} 0 parcelworks\n{COLUMNS[version]}\n".encode()
    return f"filedesc://pages.arc {NO_ADDRESS} {DATE} text/plain {len(block)}\n".encode() + block


def _arc_rows(version: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            for part in slices(batch, "html"):
                out = [] if begun else [arc_version_record(version)]
                begun = True
                keys, urls = part.column("page_id").to_pylist(), part.column("url").to_pylist()
                for key, url, html in zip(keys, urls, text_list(part.column("html"))):
                    head = (
                        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(html)}\r\n{KEY_HEADER}: {'' if key is None else key}\r\n\r\n"
                    )
                    out.append(arc_record(version, _address(url), "text/html", head.encode() + html))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return rows


def write_arc(pages: DataFrame, folder: str, version: int) -> None:
    """Pages (page_id, url, html) as ARC files of one version; a null html is an empty payload."""
    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html"))
    records = narrow.mapInArrow(_arc_rows(version), "record binary").selectExpr("CAST(record AS string) AS value")
    # read twice and then done with, so packed fast rather than small
    fast = records.write.mode("append").option("zlib.compress.level", "BEST_SPEED")
    fast.text(folder, lineSep="\n", compression="gzip")


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields by name and block of each record of an ARC file, but for the version records."""
    at, names = 0, COLUMNS[1].split()
    while at < len(data):
        line_end = data.index(b"\n", at)
        line = data[at:line_end].decode("utf-8")
        length = int(line.rpartition(" ")[2])
        block = data[line_end + 1 : line_end + 1 + length]
        if len(block) < length:
            raise ValueError(f"an ARC record at byte {at} is cut off")
        if line.startswith("filedesc:"):
            names = block.decode("utf-8").split("\n")[1].split()
        else:
            fields = line.split(" ")
            if len(fields) != len(names):
                raise ValueError(f"an ARC header line has {len(fields)} fields, not {len(names)}: {line[:200]}")
            yield dict(zip(names, fields)), block
        at = line_end + 1 + length + 1


def _unpacked(content: pa.Scalar) -> bytes:
    data = content.as_py()
    if data[:2] != b"\x1f\x8b":
        return data
    out, rest = [], data
    while rest:
        unpack = zlib.decompressobj(31)
        out.append(unpack.decompress(rest))
        rest = unpack.unused_data
    return b"".join(out)


PARSED = pa.schema(
    [
        ("key", pa.int64()), ("address", pa.string()), ("date", pa.string()), ("digest", pa.string()),
        ("payload_bytes", pa.int64()), ("head", pa.string()), ("payload", pa.string()),
    ]
)


def _parsed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            out, held = [], 0
            for fields, block in arc_records(_unpacked(content)):
                head, _, payload = block.partition(b"\r\n\r\n")
                key = re.search(rb"(?i)\r\n%s: *([-0-9]*)" % KEY_HEADER.encode(), head)
                row = (
                    int(key[1]) if key and key[1] else None, fields["URL"], fields["Archive-date"],
                    digest_of(payload), len(payload), head.decode("utf-8"), payload.decode("utf-8"),
                )
                out.append(row)
                held += len(payload)
                if held >= 4_000_000:
                    yield batch_of(PARSED, **dict(zip(PARSED.names, zip(*out))))
                    out, held = [], 0
            if out:
                yield batch_of(PARSED, **dict(zip(PARSED.names, zip(*out))))


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of ARC files of either version, with the digest of each payload."""
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("content")
    return files.mapInArrow(
        _parsed_rows,
        "key long, address string, date string, digest string, payload_bytes long, head string, payload string",
    )


def _iso(date: str) -> str:
    d = (date + "0" * 14)[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(address: str, date: str, digest: str, key) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{address} {date} {digest} {key}')}>"


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "payload", 4_000_000):
            out = []
            for row in part.to_pylist():
                revisit = row["refers_to"] is not None
                block = (row["head"] + "\r\n\r\n" + ("" if revisit else row["payload"])).encode("utf-8")
                lines = [
                    "WARC/1.1",
                    f"WARC-Type: {'revisit' if revisit else 'response'}",
                    f"WARC-Record-ID: {record_id(row['address'], row['date'], row['digest'], row['key'])}",
                    f"WARC-Target-URI: {row['address']}",
                    f"WARC-Date: {_iso(row['date'])}",
                    f"WARC-Payload-Digest: sha1:{row['digest']}",
                    f"WARC-Block-Digest: sha1:{digest_of(block)}",
                    "Content-Type: application/http;msgtype=response",
                    f"Content-Length: {len(block)}",
                ]
                if revisit:
                    of = record_id(row["first_address"], row["first_date"], row["digest"], row["refers_to"])
                    lines[2:2] = [
                        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                        f"WARC-Refers-To: {of}",
                        f"WARC-Refers-To-Target-URI: {row['first_address']}",
                        f"WARC-Refers-To-Date: {_iso(row['first_date'])}",
                        f"X-Refers-To-Key: {row['refers_to']}",
                    ]
                out.append("\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, least_bytes: int = 0) -> None:
    """ARC files of either version as WARC files.

    Payloads are equal if their SHA-1 digests and lengths are. A record without a key is never a
    revisit nor what one refers to. The files are read twice: the first pass keeps digests only,
    of which one row per distinct payload and task is shuffled; the second deals each record to
    the decision on it.
    """
    records = read_arc(spark, arc_folder)
    firsts = (
        records.select("digest", "payload_bytes", "key", "address", "date")
        .filter(f"key IS NOT NULL AND payload_bytes >= {int(least_bytes)}")
        .groupBy("digest", "payload_bytes")
        .agg(F.expr("min(struct(key, address, date)) AS first"), F.expr("count(*) AS copies"))
        .filter("copies > 1")
        .selectExpr("digest", "payload_bytes", "first")
    )
    decided = records.join(firsts, ["digest", "payload_bytes"], "left").selectExpr(
        "key", "address", "date", "digest", "head", "payload",
        "CASE WHEN key > first.key THEN first.key END AS refers_to",
        "first.address AS first_address", "first.date AS first_date",
    )
    written = decided.mapInArrow(_warc_rows, "record binary").selectExpr("CAST(record AS string) AS value")
    written.write.text(warc_folder, lineSep=BETWEEN_WARC, compression="gzip")


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields by lower-case name and block of each record of a WARC file."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        begin = head_end + 4
        end = begin + int(fields["content-length"])
        yield fields, data[begin:end]
        at = end + 4


READ = pa.schema(
    [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
        ("target_uri", pa.string()), ("warc_date", pa.string()),
    ]
)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            out = []
            for fields, block in warc_records(_unpacked(content)):
                head, _, payload = block.partition(b"\r\n\r\n")
                http = {
                    name.lower(): value.strip()
                    for name, _, value in (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])
                }
                revisit = fields["warc-type"] == "revisit"
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if digest_of(block) != fields["warc-block-digest"].removeprefix("sha1:"):
                    raise ValueError(f"{fields['warc-record-id']}: the block digest does not match")
                if not revisit and digest_of(payload) != digest:
                    raise ValueError(f"{fields['warc-record-id']}: the payload digest does not match")
                key = http[KEY_HEADER.lower()]
                out.append((
                    int(key) if key else None, int(http["content-length"]) if revisit else len(payload), digest,
                    fields["warc-type"], int(fields["x-refers-to-key"]) if revisit else None,
                    fields["warc-record-id"], fields["warc-target-uri"], fields["warc-date"],
                ))
            if out:
                yield batch_of(READ, **dict(zip(READ.names, zip(*out))))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of WARC files: key, payload length and digest, type, key referred to, id, address, date.

    A revisit's length and digest are those of the full payload, from its HTTP header and its
    digest field. Block digests, and payload digests of responses, are checked.
    """
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("content")
    return files.mapInArrow(
        _read_rows,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "record_id string, target_uri string, warc_date string",
    )


def archived(pages: DataFrame, least_bytes: int = 0, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Pages written as legacy archives, converted to WARC, and read back; one row per page.

    Pages are shared out over the ARC versions by a hash of their key. Null html is an empty
    payload, a null address ``unknown:``. An empty table gives no row.
    """
    spark = pages.sparkSession
    arc, warc = new_folder(spark, "arc"), new_folder(spark, "warc")
    dealt = pages.select("page_id", "url", "html", F.expr(f"pmod(hash({quoted('page_id')}), {len(versions)})").alias("at"))
    for place, version in enumerate(versions):
        write_arc(dealt.filter(F.col("at") == place), arc, version)
    convert(spark, arc, warc, least_bytes)
    return read_warc(spark, warc)
