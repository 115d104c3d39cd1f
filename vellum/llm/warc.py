"""Legacy ARC archives, and their conversion to WARC.

``write_arc`` stores rows as ARC records (version 1 or 2 header lines, one gzip
member per record), ``scan_arc`` parses the header lines by the version that
the file's own ``filedesc`` record declares and takes each body by its
declared length, ``arc_to_warc`` synthesises the WARC equivalents (record ids,
timestamps, types, digests) and writes them, and ``read_warc`` reads WARC
archives back. Payloads never pass through a shuffle: only the records'
headers do, when equal payloads are looked for. A task writes files under
names of its own attempt and returns them as rows, so a repeated task adds no
record: archives are only ever reached through the returned manifest.

Defined results: a NULL body is empty; a NULL url is ``about:blank``; a NULL
id stays NULL and never wins over a known id among equal payloads; repeated
rows are records of their own (equal ids: the later record in the archives is
the response); an empty table gives an empty manifest and no rows; further
columns are ignored. A body that is no HTTP message becomes a ``resource``
record. An archive that ends inside a record is an error naming the place.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import checkpointed, prepare, session_partitions
from vellum.session import local_path, shared_dir

#: Field order of the url record line, by the version that a file declares (fixed by the format).
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROW_HEADER = b"X-Archive-Row"
FILE_BYTES = 64 << 20
SMALLEST_REVISIT = 1000

META = (
    "path string, ordinal long, record_id string, row_id long, url string, ip string, date string, mime string, "
    "version int, is_http boolean, payload_bytes long, payload_sha1 string"
)


def _open(path: str, mode: str) -> BinaryIO:
    plain = local_path(path)
    fs, where = (pafs.LocalFileSystem(), plain) if plain.startswith("/") else pafs.FileSystem.from_uri(path)
    if mode == "r":
        return fs.open_input_file(where)
    fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(where, compression=None)


# --- ARC ---------------------------------------------------------------------


def arc_line(version: int, values: dict[str, str]) -> bytes:
    return (" ".join(str(values.get(f, "-")) for f in ARC_FIELDS[version]) + "\n").encode()


def parse_arc_line(line: bytes, version: int) -> dict[str, str]:
    """Fields of a url record line; taken from the right, as old urls may hold blanks."""
    fields = ARC_FIELDS[version]
    parts = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(fields) - 1)
    if len(parts) != len(fields) or not parts[-1].isdigit():
        raise ValueError(f"not an ARC version {version} record line: {line[:200]!r}")
    return dict(zip(fields, parts, strict=True))


def filedesc(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 vellum\n{ARC_TITLES[version]}\n\n".encode()
    head = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "mime": "text/plain"}
    more = {"status": "200", "offset": "0", "filename": name, "length": str(len(body))}
    return arc_line(version, head | more) + body


def _clean_url(url: str | None) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else "about:blank"


def _http(row_id, payload: bytes) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(payload)
    if row_id is not None:
        head += b"%s: %d\r\n" % (ROW_HEADER, row_id)
    return head + b"\r\n" + payload


def _arc_writer(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = TaskContext.get()
        part, attempt = (ctx.partitionId(), uuid.uuid4().hex[:8]) if ctx else (0, "0")
        out, made, size, number = None, [], 0, 0

        def start():
            nonlocal out, size, number
            name = f"rows-{part:06d}-{number:05d}.arc"
            version = 1 + (part + number) % 2
            path = f"{folder}/{name[:-4]}-{attempt}.arc.gz"
            out, size, number = _open(path, "w"), 0, number + 1
            out.write(gzip.compress(filedesc(name, version, date), 1))
            made.append((path, version))
            return name, version

        for pdf in batches:
            for row_id, url, body in zip(pdf["row_id"], pdf["url"], pdf["body"], strict=True):
                if out is None:
                    name, version = start()
                block = _http(None if pd.isna(row_id) else int(row_id), (body or "").encode())
                values = {"url": _clean_url(url), "ip": "0.0.0.0", "date": date, "mime": "text/html"}
                values |= {"status": "200", "offset": str(size), "filename": name, "length": str(len(block))}
                record = arc_line(version, values) + block + b"\n"
                out.write(gzip.compress(record, 1))
                size += len(record)
                if size >= file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pd.DataFrame(made, columns=["path", "version"])

    return run


def write_arc(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    date: str = "20200101000000",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Store rows as ARC files in the shared folder; the manifest (path, version) is returned.

    Files alternate between the two header versions.
    """
    prepare(df.sparkSession)
    folder = shared_dir(df.sparkSession, "arc")
    rows = df.select(F.col(id_col).cast("long").alias("row_id"), F.col(url_col).alias("url"), F.col(body_col).alias("body"))
    return checkpointed(rows.mapInPandas(_arc_writer(folder, date, file_bytes), "path string, version int"))


def arc_records(path: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(ordinal, header fields, body) of each record after the filedesc, one at a time."""
    with _open(path, "r") as raw:
        f = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18)
        first = f.readline()
        if not first.startswith(b"filedesc://"):
            raise ValueError(f"{path}: no filedesc record")
        # The version stands in the body's first line; the record line's own length is its last field.
        about = f.read(int(first.split()[-1]))
        version = int(about.split(None, 1)[0])
        name = first.split()[0].decode().removeprefix("filedesc://")
        ordinal = 0
        while line := f.readline():
            if not line.strip():
                continue
            head = parse_arc_line(line, version)
            body = f.read(int(head["length"]))
            if len(body) != int(head["length"]):
                raise ValueError(f"{path}: record {ordinal} ends early")
            yield ordinal, head | {"version": version, "name": name}, body
            ordinal += 1


def split_http(body: bytes) -> tuple[bytes, bytes, bool]:
    """(message head with its blank line, payload, whether it is an HTTP message)."""
    end = body.find(b"\r\n\r\n") if body.startswith(b"HTTP/") else -1
    return (body[: end + 4], body[end + 4 :], True) if end >= 0 else (b"", body, False)


def _http_field(head: bytes, name: bytes) -> bytes | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower():
            return value.strip()
    return None


def record_uuid(name: str, ordinal: int) -> str:
    """The same ARC record always gets the same WARC identifier."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{name}#{ordinal}')}"


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [x.split()[0] for x in META.split(", ")]
    for pdf in batches:
        for path in pdf["path"]:
            rows = []
            for ordinal, head, body in arc_records(path):
                http, payload, is_http = split_http(body)
                row_id = _http_field(http, ROW_HEADER) if is_http else None
                rows.append((
                    path, ordinal, record_uuid(head["name"], ordinal), int(row_id) if row_id else None, head["url"], head["ip"],
                    head["date"], head["mime"], head["version"], is_http, len(payload), hashlib.sha1(payload).hexdigest(),
                ))
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=columns).astype({"row_id": "Int64"})
                    rows = []
            yield pd.DataFrame(rows, columns=columns).astype({"row_id": "Int64"})


def scan_arc(manifest: DataFrame) -> DataFrame:
    """One row per ARC record: header fields, payload length and digest, WARC identifier; no payload."""
    prepare(manifest.sparkSession)
    return manifest.select("path").mapInPandas(_scan, META)


# --- WARC --------------------------------------------------------------------


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def warc_date(arc_date: str) -> str:
    """14 digits (shorter ones are padded to the period's start) as a W3C timestamp."""
    d = (arc_date + "00000101000000"[len(arc_date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def base32_digest(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def hex_digest(labelled: str) -> str:
    return base64.b32decode(labelled.removeprefix("sha1:")).hex()


def _converter(folder: str):
    def run(decisions: pd.DataFrame) -> pd.DataFrame:
        path = decisions["path"].iloc[0]
        refers = dict(zip(decisions["ordinal"], zip(decisions["refers_id"], decisions["refers_url"], strict=True), strict=True))
        target = f"{folder}/{path.rsplit('/', 1)[1].removesuffix('.arc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
        with _open(target, "w") as out:
            about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_uuid(path, -1)}>"), ("WARC-Date", warc_date("2020"))]
            info = b"software: vellum\r\nformat: WARC File Format 1.1\r\n"
            out.write(gzip.compress(warc_record([*about, ("Content-Type", "application/warc-fields")], info), 1))
            for ordinal, head, body in arc_records(path):
                http, payload, is_http = split_http(body)
                refers_id, refers_url = refers.get(ordinal, (None, None))
                kind = ("revisit" if refers_id else "response") if is_http else "resource"
                fields = [
                    ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_uuid(head['name'], ordinal)}>"),
                    ("WARC-Target-URI", head["url"]), ("WARC-Date", warc_date(head["date"])), ("WARC-IP-Address", head["ip"]),
                    ("WARC-Payload-Digest", base32_digest(hashlib.sha1(payload).hexdigest())),
                    ("Content-Type", "application/http; msgtype=response" if is_http else head["mime"]),
                ]
                if kind == "revisit":
                    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Truncated", "length")]
                    fields += [("WARC-Refers-To", f"<{refers_id}>"), ("WARC-Refers-To-Target-URI", refers_url)]
                out.write(gzip.compress(warc_record(fields, http if kind == "revisit" else body), 1))
        return pd.DataFrame({"path": [target]})

    return run


def decide(meta: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """Adds refers_id and refers_url: for a record whose payload a later-numbered record has too, that record."""
    groups = (
        meta.where((F.col("payload_bytes") >= smallest) & F.col("is_http"))
        .groupBy("payload_sha1", "payload_bytes")
        .agg(F.count("*").alias("n"), F.max(F.struct("row_id", "path", "ordinal", "record_id", "url")).alias("best"))
        .where("n > 1")
        .select("payload_sha1", "payload_bytes", F.col("best.record_id").alias("best_id"), F.col("best.url").alias("best_url"))
    )
    # Written once, so that the join has a plain exchange on both sides and a hot digest can be split.
    groups = checkpointed(groups)
    joined = meta.join(groups, ["payload_sha1", "payload_bytes"], "left")
    other = F.col("best_id") != F.col("record_id")
    return joined.select(
        "path", "ordinal", F.when(other, F.col("best_id")).alias("refers_id"), F.when(other, F.col("best_url")).alias("refers_url")
    )


def arc_to_warc(manifest: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """Convert every ARC file of the manifest into one WARC file; the new manifest (path) is returned.

    A file's decisions are gathered by its path: a bounded group, as files are.
    """
    spark = manifest.sparkSession
    folder = shared_dir(spark, "warc")
    decisions = decide(checkpointed(scan_arc(manifest)), smallest)
    # Few bytes here, but whole files of work: an explicit width keeps the files on separate tasks.
    decisions = decisions.repartition(2 * session_partitions(spark), "path")
    return checkpointed(decisions.groupBy("path").applyInPandas(_converter(folder), "path string"))


def warc_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record, one at a time."""
    with _open(path, "r") as raw:
        f = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18)
        while line := f.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: not a WARC record: {line[:80]!r}")
            head: dict[str, str] = {}
            while (line := f.readline()).strip():
                key, _, value = line.decode().partition(":")
                head[key.strip().lower()] = value.strip()
            block = f.read(int(head["content-length"]))
            if len(block) != int(head["content-length"]):
                raise ValueError(f"{path}: a record ends early")
            yield head, block


WARC_ROW = "record_id string, record_type string, row_id long, url string, date string, payload_bytes long, payload_digest string, refers_id string"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [x.split()[0] for x in WARC_ROW.split(", ")]
    for pdf in batches:
        for path in pdf["path"]:
            rows = []
            for head, block in warc_records(path):
                kind = head["warc-type"]
                if kind == "warcinfo":
                    continue
                http, payload, _ = split_http(block)
                digest = hex_digest(head["warc-payload-digest"])
                if kind == "revisit":
                    size = int(_http_field(http, b"Content-Length"))
                else:
                    size = len(payload)
                    if hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: {head['warc-record-id']} does not have its digest")
                row_id = _http_field(http, ROW_HEADER)
                refers = head.get("warc-refers-to")
                rows.append((
                    head["warc-record-id"].strip("<>"), kind, int(row_id) if row_id else None, head.get("warc-target-uri"),
                    head["warc-date"], size, digest, refers.strip("<>") if refers else None,
                ))
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=columns).astype({"row_id": "Int64"})
                    rows = []
            yield pd.DataFrame(rows, columns=columns).astype({"row_id": "Int64"})


def read_warc(manifest: DataFrame) -> DataFrame:
    """One row per WARC record of the manifest's files, payload digests verified."""
    prepare(manifest.sparkSession)
    return manifest.select("path").mapInPandas(_read, WARC_ROW)


def op6_arc_to_warc(spark, sf_dir: str) -> DataFrame:
    """All pages through ARC and WARC archives and back: one row per page."""
    from vellum.llm.common import table

    records = checkpointed(read_warc(arc_to_warc(write_arc(table(spark, sf_dir, "pages")))))
    columns = ["row_id", "payload_bytes", "payload_digest", "record_type"]
    targets = records.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_id"), F.col("row_id").alias("refers_to"))
    revisits = records.where("record_type = 'revisit'").join(targets, "refers_id", "left").select(*columns, "refers_to")
    whole = records.where("record_type <> 'revisit'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return whole.unionByName(revisits).withColumnRenamed("row_id", "page_id")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""
