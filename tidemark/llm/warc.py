"""WARC archives: written in parallel, read back, and put together into captures.

An archive is a folder of ``.warc.gz`` files, each record a gzip member of its
own.  A capture is a response or a revisit (a response whose payload is that of
another); its request and its metadata are records of their own that name it as
concurrent.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.rows import MOST_KEYS, numbered, repeating
from tidemark.llm.scratch import Scratch, owned, shared_dir
from tidemark.llm.token_store import store_of

#: Bytes after which a task begins another file.
ROLL = 64 << 20
LEVEL = 3
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit", "resource")
SIDES = ("request", "metadata")

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = (
    "path string, number long, record_id string, kind string, uri string, date string, concurrent_to array<string>, refers_to string, "
    "payload_bytes long, payload_digest string, fields map<string,string>, payload binary, error string"
)
_RECORDS = pa.schema(
    [
        ("path", pa.string()), ("number", pa.int64()), ("record_id", pa.string()), ("kind", pa.string()), ("uri", pa.string()), ("date", pa.string()),
        ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("error", pa.string())
    ]
)
_SPACES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest(payload: bytes) -> str:
    """SHA-1 in bare upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(kind: str, key: int) -> str:
    """The identifier of a record of ours: the same whenever a task is repeated."""
    return f"<urn:uuid:{uuid.uuid5(_SPACES, f'{kind}/{key}')}>"


def record(kind: str, rid: str, date: str, block: bytes, **headers: str | None) -> bytes:
    """One record as a gzip member; headers are given with underscores for hyphens, null ones are left out."""
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {date}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items() if v is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return zlib.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", LEVEL, wbits=31)


def target(url: str | None, key: int) -> str:
    """A URL fit for a header: spaces and control characters percent-encoded; a URN where there is none."""
    return re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{key}"


def page_records(key: int, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> list[bytes]:
    """The request, response or revisit, and metadata records of a page."""
    uri, sha = target(url, key), f"sha1:{digest(payload)}"
    at = record_id("response", key)
    try:
        parts = urlsplit(uri)
        host, path = parts.netloc, (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    except ValueError:  # unbalanced brackets
        host, path = "", "/"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    message = {"Content_Type": "application/http; msgtype=response", "WARC_Target_URI": uri, "WARC_Payload_Digest": sha}
    if refers_to is None:
        capture = record("response", at, date, http + payload, **message)
    else:
        capture = record("revisit", at, date, http, **message, WARC_Profile=PROFILE, WARC_Refers_To=record_id("response", refers_to))
    request = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    about = b"" if page_id is None else f"pageId: {page_id}\r\n".encode()
    return [
        record("request", record_id("request", key), date, request, Content_Type="application/http; msgtype=request", WARC_Target_URI=uri, WARC_Concurrent_To=at),
        capture,
        record("metadata", record_id("metadata", key), date, about, Content_Type="application/warc-fields", WARC_Target_URI=uri, WARC_Concurrent_To=at)
    ]


def _write(batches: Iterator[pa.RecordBatch], root: str, date: str) -> Iterator[pa.RecordBatch]:
    """Write a partition's records; a repeated attempt writes files of other names, and the manifest lists those of one attempt."""
    store, path = store_of(root)
    out, name, count, size = None, "", 0, 0

    def closed() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_pylist([{"path": f"{root}/{name}", "n_records": count, "n_bytes": size}])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "page_id", "url")] + [batch.column("html").cast(pa.binary()), batch.column("refers_to").to_pylist()]
        for key, page_id, url, html, refers_to in zip(*columns, strict=True):
            if out is None:
                name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}", compression=None)
                head = record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", date, b"format: WARC File Format 1.1\r\n", Content_Type="application/warc-fields", WARC_Filename=name)
                out.write(head)
                count, size = 1, len(head)
            data = b"".join(page_records(key, page_id, url, html.as_py(), refers_to, date))
            out.write(data)
            count, size = count + 3, size + len(data)
            if size >= ROLL:
                yield closed()
                out = None
    if out is not None:
        yield closed()


def write_pages(pages: DataFrame, root: str, scratch: Scratch, *, least: int = 0, date: str = "2024-01-01T00:00:00Z", most: int = MOST_KEYS) -> DataFrame:
    """Archive (key, page_id, url, html) below the URI ``root`` and return the manifest of files.

    Of pages with equal payloads of at least ``least`` bytes the one with the
    largest page_id (null the smallest, then the largest key) is a response,
    the others revisit it.  Payloads are equal by length and SHA-256.  Nothing
    that is in the folder is touched.
    """
    html = F.coalesce("html", F.lit(""))
    sums = pages.select("key", "page_id", F.sha2(html, 256).alias("sha"), F.octet_length(html).cast("long").alias("size")).where(F.col("size") >= least)
    sums = scratch.keep(sums, "sums")
    heads = sums.groupBy("sha", "size").agg(F.max(F.struct("page_id", "key")).alias("top"), F.count("*").alias("n")).where("n > 1")
    heads = scratch.keep(heads, "heads")
    again = scratch.keep(sums.join(heads, ["sha", "size"]).select("key", F.col("top.key").alias("refers_to")).where("key <> refers_to"), "again")
    few = F.broadcast(again) if again.count() <= most else again  # so that no html is shuffled
    rows = pages.join(few, "key", "left").select("key", "page_id", "url", html.alias("html"), "refers_to")
    return scratch.keep(rows.mapInArrow(lambda it: _write(it, root, date), MANIFEST), "manifest")


def _plain(store, path: str) -> Iterator[bytes]:
    """A file's bytes; gzip members, one or many, are unpacked."""
    with store.open_input_stream(path, compression=None) as f:
        data = f.read(1 << 18)
        if data[:2] != b"\x1f\x8b":
            while data:
                yield data
                data = f.read(1 << 18)
            return
        unpacker = zlib.decompressobj(31)
        while data:
            yield unpacker.decompress(data)
            data = unpacker.unused_data
            if unpacker.eof:
                unpacker = zlib.decompressobj(31)
            data = data or f.read(1 << 18)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, list[str]] | None, bytes, str | None]]:
    """Headers by lower-case name, block and error of each record; nothing is read past the first error."""
    held = bytearray()
    broken = ""

    def more() -> bool:
        nonlocal broken
        try:
            held.extend(next(chunks))
        except StopIteration:
            return False
        except zlib.error as e:
            broken = f"the file can't be unpacked: {e}"
            return False
        return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if broken or held.strip():
                    yield None, b"", broken or "the file ends within a header"
                return
        lines = held[:end].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        headers: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = headers.get("content-length", [""])[0]
        if not lines[0].startswith("WARC/") or not size.isdecimal():
            yield None, b"", "not a record header"
            return
        del held[: end + 4]
        size = int(size)
        while len(held) < size:
            if not more():
                yield headers, bytes(held), broken or "the file ends within a record"
                return
        yield headers, bytes(held[:size]), None
        del held[:size]
        while len(held) < 4 and more():
            pass
        del held[: 4 if held[:4] == b"\r\n\r\n" else 0]


def unchunked(body: bytes) -> bytes:
    """A body in chunked transfer coding as it was before; what isn't chunks stays as it is."""
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(b"[0-9A-Fa-f]+", size):
            return body
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2
    return body


def payload_of(kind: str, content_type: str, block: bytes) -> bytes:
    """The payload of a record: an HTTP message's body, or the whole block."""
    if not content_type.startswith("application/http"):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?mi)^transfer-encoding:[^\r\n]*chunked", head) else body


def _row(headers: dict[str, list[str]] | None, block: bytes, error: str | None, with_payload: bool) -> dict:
    if headers is None:
        return {"error": error}
    one = lambda name: headers.get(name, [None])[0]
    kind, told = (one("warc-type") or "").lower(), (one("warc-payload-digest") or "").partition(":")[2].upper() or None
    row = {
        "record_id": one("warc-record-id"), "kind": kind, "uri": one("warc-target-uri"), "date": one("warc-date"),
        "concurrent_to": headers.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"), "error": error
    }
    if kind == "revisit":
        return row | {"payload_digest": told}
    content_type = one("content-type") or ""
    payload = payload_of(kind, content_type, block)
    if content_type.startswith("application/warc-fields"):
        pairs = (line.partition(":") for line in block.decode("utf-8", "replace").splitlines())
        row["fields"] = list({name.strip(): value.strip() for name, colon, value in pairs if colon}.items())
    if kind in CAPTURES:
        made = digest(payload)
        row |= {"payload_bytes": len(payload), "payload_digest": made}
        if told and len(told) == len(made) and told != made and not error:
            row["error"] = "the payload isn't that of its digest"
    return row | ({"payload": payload} if with_payload else {})


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            store, path = store_of(uri)
            rows, size, number = [], 0, 0
            for found in records(_plain(store, path)):
                rows.append(_row(*found, with_payload) | {"path": uri, "number": number})
                number, size = number + 1, size + 500 + len(found[1]) * with_payload
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, _RECORDS)


def read_records(manifest: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """Return a row for each record of the files in ``path``, gzipped by record, as a whole or not at all.

    Payloads are HTTP bodies without transfer coding, or else whole blocks;
    their digests are made from the bytes that were read, but for revisits,
    which have none.  A record that is cut off, has no header or another
    payload than its digest says has an ``error``; what follows the first two
    in a file can't be read.
    """
    files = max(1, manifest.count())
    return manifest.select("path").repartition(files, "path").mapInArrow(lambda it: _read(it, with_payload), RECORDS)


def transactions(found: DataFrame, scratch: Scratch) -> DataFrame:
    """Put records together: a row for each response, revisit and resource, with its request and its metadata nested.

    Records belong together where one names the other as concurrent, either
    way, or over one record between them.  Of several requests of a capture
    the one with the smallest identifier is nested, ``n_requests`` counts all;
    the same for metadata.  Requests and metadata without a capture have rows of their own
    whose ``record_id`` is null, so do records that can't be read.  Rows that
    repeat an identifier are captures of their own.
    """
    found = scratch.keep(found, "records")
    captures = found.where(F.col("kind").isin(*CAPTURES) & F.col("record_id").isNotNull())
    side = F.struct("record_id", "uri", "date", F.map_entries("fields").alias("fields"), "path", "number").alias("side")
    sides = found.where(F.col("kind").isin(*SIDES)).select("path", "number", "kind", side, F.explode_outer("concurrent_to").alias("to"))
    ids = captures.select(F.col("record_id").alias("to")).distinct()
    pairs = sides.join(ids, "to", "left_semi").select(F.col("to").alias("capture"), "path", "number", "kind", "side")
    named = captures.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("id"))
    if not named.isEmpty():
        back = sides.join(named, F.col("side.record_id") == F.col("id")).select("capture", "path", "number", "kind", "side")
        pairs = pairs.unionByName(back).distinct()
    pairs = scratch.keep(pairs, "pairs")
    alone = scratch.keep(sides.join(pairs.select("path", "number"), ["path", "number"], "left_anti"), "alone")
    if not alone.isEmpty():  # they may name no capture but a record that belongs to one
        known = pairs.select(F.col("side.record_id").alias("id"), "capture")
        over = alone.join(known, F.col("to") == F.col("id")).select("capture", "path", "number", "kind", "side").distinct()
        pairs = scratch.keep(pairs.unionByName(over), "all_pairs")
        alone = alone.join(over.select("path", "number"), ["path", "number"], "left_anti")

    def first(kind: str, count: str) -> list[F.Column]:
        mine = F.when(F.col("kind") == kind, F.col("side"))
        return [F.min(mine).alias(kind), F.count(mine).alias(count)]

    nested = pairs.groupBy(F.col("capture").alias("record_id")).agg(*first("request", "n_requests"), *first("metadata", "n_metadata"))
    plain = ["record_id", "kind", "uri", "date", "refers_to", "payload_bytes", "payload_digest", "payload", "request", "metadata", "n_requests", "n_metadata", "error"]
    whole = captures.join(nested, "record_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_requests", "n_metadata")}).select(plain)
    lone = alone.dropDuplicates(["path", "number"]).select(*(F.when(F.col("kind") == k, F.col("side")).alias(k) for k in SIDES))
    broken = found.where(F.col("record_id").isNull() & F.col("error").isNotNull() & ~F.coalesce(F.col("kind").isin(*SIDES), F.lit(False))).select("error")
    return whole.unionByName(lone, allowMissingColumns=True).unionByName(broken, allowMissingColumns=True).select(plain)


def revisited(captures: DataFrame, scratch: Scratch) -> DataFrame:
    """Add ``of``: for each revisit the nested response that it refers to, if that is there; its payload's size where its own is null."""
    heads = captures.where("kind = 'response'").groupBy(F.col("record_id").alias("refers_to"))
    # Written, so that a response with many revisits is a skewed join that Spark can split.
    heads = scratch.keep(heads.agg(F.min(F.struct("record_id", "uri", "payload_bytes", "metadata")).alias("of")), "heads")
    joined = captures.join(heads, "refers_to", "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", F.col("of.payload_bytes")))


def warc_round_trip(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0, root: str | None = None
) -> DataFrame:
    """Archive pages as UTF-8 payloads and return what the archives say of each.

    A null html is an empty payload, a null URL a URN.  Pages whose id is null
    or repeats are records of their own; a null id is smaller than any other.
    An empty table gives an empty archive; other columns are ignored.
    """
    spark: SparkSession = pages.sparkSession
    scratch = Scratch(spark, "warc")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    keyed = numbered(base, "page_id", "html", scratch, "key") if repeating(base, "page_id") else base.withColumn("key", F.col("page_id"))
    manifest = write_pages(keyed, root or owned(spark, f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"), scratch, least=least)
    captures = scratch.keep(transactions(read_records(manifest), scratch).where("record_id is not null"), "captures")

    def page(metadata: str) -> F.Column:
        return F.element_at(F.map_from_entries(f"{metadata}.fields"), "pageId").cast("long")

    out = revisited(captures, scratch).select(
        page("metadata").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), page("of.metadata").alias("refers_to"),
        "record_id", "uri", "error"
    )
    return scratch.result(out)
