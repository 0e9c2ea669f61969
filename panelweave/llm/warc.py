"""Zstandard WARC archives: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.llm.common import new_path, written

# Fixed values of the .warc.zst format.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
ZSTD_FRAME = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

READ_SCHEMA = (
    "archive string, position long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)
MANIFEST_SCHEMA = "archive string, records long, bytes long"
BLOCK = 1 << 20


def filesystem(uri: str):
    """pyarrow's file system of a folder or file address, and the path in it."""
    from pyarrow import fs

    if "://" not in uri:  # file:/x and /x
        uri = f"file://{uri.removeprefix('file:')}"
    return fs.FileSystem.from_uri(uri)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """A response with its payload, or a revisit that keeps the headers only (refers_to is (id,) or None)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to[0]}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def frames(stream) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(position, decoded frame, what is wrong with it) of each record's frame, in bounded memory.

    The dictionary is taken from the leading skippable frame, itself stored plainly or as a frame;
    later skippable frames are passed over. A damaged frame ends the archive, since what follows
    cannot be aligned.
    """
    import zstandard

    rest, position, dictionary = stream.read(BLOCK), 0, None

    def need(n: int) -> bool:
        nonlocal rest
        while len(rest) < n and (more := stream.read(BLOCK)):
            rest += more
        return len(rest) >= n

    while need(1):
        if not need(4):
            yield position, None, "cut frame header"
            return
        magic = struct.unpack("<I", rest[:4])[0]
        if magic in SKIPPABLE_FRAMES:
            if not need(8) or not need(8 + (size := struct.unpack("<I", rest[4:8])[0])):
                yield position, None, "cut skippable frame"
                return
            if magic == DICTIONARY_FRAME and position == 0:
                raw = rest[8 : 8 + size]
                if raw[:4] == struct.pack("<I", ZSTD_FRAME):
                    raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                dictionary = zstandard.ZstdCompressionDict(raw)
            rest, position = rest[8 + size :], position + 8 + size
            continue
        if magic != ZSTD_FRAME:
            yield position, None, "not a frame"
            return
        decoder = zstandard.ZstdDecompressor(**({"dict_data": dictionary} if dictionary else {})).decompressobj()
        parts, used = [], 0
        try:
            while not decoder.eof:
                if not rest and not need(1):
                    yield position, None, "cut frame"
                    return
                parts.append(decoder.decompress(rest))
                used += len(rest)
                rest = decoder.unused_data if decoder.eof else b""
        except zstandard.ZstdError as error:
            yield position, None, f"damaged frame: {error}"
            return
        yield position, b"".join(parts), None
        position += used - len(rest)


def header_lines(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without colon")
        fields[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    return fields


def parse(data: bytes) -> dict:
    """The fields of one record; raises ValueError where a header, length or digest is wrong."""
    head, gap, body = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        raise ValueError("no WARC header")
    fields = header_lines(head)
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ValueError(f"missing {', '.join(missing)}")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    length = int(fields["content-length"])
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError("the frame is not one record of Content-Length bytes")
    out = {
        "record_type": fields["warc-type"],
        "record_id": fields["warc-record-id"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
    }
    if out["record_type"] not in ("response", "revisit"):
        return out | {"payload": body[:length], "payload_bytes": length}
    http, gap, payload = body[:length].partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP header")
    stated = header_lines(http).get("content-length", "")
    if out["record_type"] == "revisit":
        if payload:
            raise ValueError("a revisit with a payload")
        return out | {"payload_bytes": int(stated) if stated.isdigit() else None}
    if stated.isdigit() and int(stated) != len(payload):
        raise ValueError("the payload is not as long as stated")
    if out["payload_digest"] and out["payload_digest"] != digest32(payload):
        raise ValueError("payload digest differs")
    return out | {"payload": payload, "payload_bytes": len(payload)}


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives whose addresses are in column `archive`.

    Archives are decoded a frame at a time inside the tasks: memory holds one record. A record that
    breaks the format gives a row with `error` and nulls; a null address gives no row, an empty file
    no rows, an unreadable file an error row.
    """

    def read(batches):
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        kinds = {"position": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names)

        rows, held = [], 0
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                if archive is None:
                    continue
                try:
                    store, path = filesystem(archive)
                    with store.open_input_stream(path, compression=None) as stream:
                        for position, data, error in frames(stream):
                            row = {"archive": archive, "position": position, "error": error}
                            if data is not None:
                                try:
                                    row |= parse(data)
                                except ValueError as wrong:
                                    row["error"] = str(wrong)
                            if not with_payload:
                                row.pop("payload", None)
                            rows.append(row)
                            held += len(data or b"")
                            if held > 16 * BLOCK or len(rows) >= 4096:
                                yield made(rows)
                                rows, held = [], 0
                except OSError as wrong:
                    rows.append({"archive": archive, "error": f"{type(wrong).__name__}: {wrong}"})
        if rows:
            yield made(rows)

    return archives.select("archive").mapInArrow(read, READ_SCHEMA)


def write_archives(pages: DataFrame, folder: str, target_bytes: int = 64 << 20, dictionary_bytes: int = 16 << 10) -> DataFrame:
    """Write rows (page_id, url, payload, first) as archives; returns the manifest of what was written.

    `first` is null for a response and a struct with the id referred to for a revisit. Each task
    writes files of about target_bytes; a file's dictionary is trained on its first 256 records or
    fewer. Names are new in every attempt and only the manifest of attempts that ended well is kept, so
    a repeated task leaves an unlisted file, never a double record.
    """

    def write(batches):
        import zstandard

        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        waiting, held, sink, name, count, size, coder = [], 0, None, "", 0, 0, None
        done: list[tuple[str, int, int]] = []

        def flush():
            nonlocal waiting, held, sink, name, count, size, coder
            if sink is None:
                name, count = f"part-{uuid.uuid4().hex}.warc.zst", 0
                sink, coder = store.open_output_stream(f"{root}/{name}", compression=None), zstandard.ZstdCompressor(level=3)
                size = 0
                samples = [x[: 8 * dictionary_bytes] for x in waiting[:256]]
                if len(samples) >= 16 and sum(map(len, samples)) >= 10 * dictionary_bytes:
                    try:
                        trained = zstandard.train_dictionary(dictionary_bytes, samples)
                    except zstandard.ZstdError:
                        trained = None  # too much alike to train on
                    if trained is not None:
                        raw = zstandard.ZstdCompressor(level=3).compress(trained.as_bytes())
                        size += sink.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
                        coder = zstandard.ZstdCompressor(level=3, dict_data=trained)
            for x in waiting:
                size += sink.write(coder.compress(x))
                count += 1
            waiting, held = [], 0
            if size >= target_bytes:
                close()

        def close():
            nonlocal sink
            if sink is not None:
                sink.close()
                done.append((f"{folder}/{name}", count, size))
                sink = None

        for batch in batches:
            for page_id, url, payload, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first")), strict=True):
                waiting.append(record(page_id, url, (payload or "").encode("utf-8"), None if first is None else (first["id"],)))
                held += len(waiting[-1])
                if len(waiting) >= 512 or held >= 8 * BLOCK:
                    flush()
        if waiting:
            flush()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["archive", "records", "bytes"])

    return written(pages.select("page_id", "url", "payload", "first").mapInArrow(write, MANIFEST_SCHEMA), "manifest")


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, salts: int = 64) -> DataFrame:
    """(page_id, url, payload, first): `first` is set where an equal payload has a smaller id.

    Groups are found by digest on thin rows, aggregated before the shuffle; the join back deals each
    group over as many salts as its rows have, so a payload that a third of all pages share is not
    one task's work. Null payloads are empty; rows with a null id refer to the smallest id that
    there is; rows that repeat the smallest id are all responses.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        (F.col(url_col) if url_col in pages.columns else F.lit(None)).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    ).withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "salt": F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int")})
    thin = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest", "salt").agg(F.min("page_id").alias("low"), F.count("*").alias("n"))
    groups = thin.groupBy("digest").agg(F.min("low").alias("low"), F.sum("n").alias("n"), F.collect_set("salt").alias("salts"))
    groups = groups.where("n > 1 AND low IS NOT NULL").select("digest", "low", F.explode("salts").alias("salt"))
    joined = rows.join(groups, ["digest", "salt"], "left")
    first = F.when(F.col("low").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("low")), F.struct(F.col("low").alias("id")))
    return joined.select("page_id", "url", "payload", first.alias("first"))


def dealt(manifest: DataFrame, task_bytes: int = 64 << 20) -> DataFrame:
    """The manifest in partitions of about task_bytes of archives each, however few rows it has.

    Archives are numbered by the bytes before them, one row for each, and a partition takes those that start in its share.
    """
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    before = F.sum("bytes").over(Window.orderBy("archive").rowsBetween(Window.unboundedPreceding, -1))
    shares = manifest.withColumn("share", F.floor(F.coalesce(before, F.lit(0)) / task_bytes).cast("int"))
    return shares.repartitionById(total // task_bytes + 1, "share").drop("share")


def page_number(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write every page as a WARC record, read the archives back, one row per record.

    A null html is an empty payload and an empty table gives no archive and no rows.
    """
    folder = new_path(spark, "warc")
    read = read_archives(dealt(write_archives(mark_revisits(pages), folder)), with_payload=False)
    return read.select(
        page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
        "target_uri",
        "error",
    )
