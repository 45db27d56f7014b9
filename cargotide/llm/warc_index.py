"""WARC archives with a two-level capture index (operator 9).

Writing. Every task writes its records, one gzip member each, to archive files of its own in the
shared folder, named after the task attempt, so a repeated task never touches another's file and
the index names only files of attempts that ended. Of records with equal long payloads the one with
the largest id is the response; the others are revisits that carry no payload.

Index. Captures are sorted by reversed-host URL key (range partitions, so a host with very many
pages is several of them) and written as compressed blocks of lines, with one directory row per
block: the first key, file, offset, length. The directory is the sparse upper level.

Reading. A lookup finds blocks by binary search in the directory, lines by binary search in the block
and reads only the record's bytes. A full read goes through the same blocks: their lines are dealt by archive
file and records are read in the order of their offsets.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .common import stored

#: Fixed value: shorter payloads are never revisits.
LONG_PAYLOAD = 1000
BLOCK_LINES = 3000
ARCHIVE_BYTES = 256 << 20
RECORD_DATE = "2000-01-01T00:00:00Z"


def file_system(path: str):
    """The file system of a folder and the path in it, for workers that open files themselves."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


def url_key(url: str | None) -> str:
    """com,example,www)/path?query: the host's labels reversed, lower case, without port and www."""
    text = "".join(c for c in (url or "") if c > " ")
    rest = text.split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    host = host.rsplit("@", 1)[-1].split(":", 1)[0].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")/" + (path if slash else "")


def record(page: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record with an HTTP response block; a revisit has the headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    url = "".join(c if c > " " else "%20" for c in url) or "urn:none"
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, page + ' ' + url)}>",
            f"WARC-Date: {RECORD_DATE}", f"WARC-Target-URI: {url}", f"WARC-Page-ID: {page}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Page: {refers_to}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, salts: int = 32) -> DataFrame:
    """page_id, url, html, digest, refers_to (null for a response). Only digests that occur more than
    once are joined back, by (digest, salt), so a payload that very many pages share is spread."""
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    slim = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))
    keyed = slim.withColumns({"digest": F.sha1(html_bytes("html")), "salt": F.pmod(F.xxhash64("page_id"), F.lit(salts))})
    shared = (keyed.where(F.octet_length("html") >= LONG_PAYLOAD).groupBy("digest")
              .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"), F.collect_set("salt").alias("own")).where("n > 1"))
    shared = stored(shared.select("digest", F.explode("own").alias("salt"), "response"), "op9-shared")
    joined = keyed.join(shared, ["digest", "salt"], "left")
    refers = F.when((F.octet_length("html") >= LONG_PAYLOAD) & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def html_bytes(column: str) -> Column:
    return F.encode(F.col(column), "UTF-8")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records; returns one stored row per capture: key, page_id, archive, offset, length."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        context, part, out, at = TaskContext.get(), 0, None, 0
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("key", "page_id", "archive", "offset", "length")}
            for page, url, html, digest, refers in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at, part = f"{context.partitionId():06d}-{context.taskAttemptId()}-{part:04d}.warc.gz", 0, part + 1
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                data = gzip.compress(record(page or "", url or "", html.encode(), digest, refers), 4, mtime=0)
                out.write(data)
                for c, v in zip(rows, (url_key(url), page, name, at, len(data))):
                    rows[c].append(v)
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(rows["key"], pa.string()), pa.array(rows["page_id"], pa.string()), pa.array(rows["archive"], pa.string()),
                                              pa.array(rows["offset"], pa.int64()), pa.array(rows["length"], pa.int64())], list(rows))
        if out is not None:
            out.close()
    text = pages.select(F.col("page_id").cast("string"), "url", "html", "digest", F.col("refers_to").cast("string"))
    return stored(text.mapInArrow(write, "key string, page_id string, archive string, offset long, length long"), "op9-captures")


def line_of(key: str, page: str | None, archive: str, offset: int, length: int) -> str:
    return "\t".join((key.replace("\t", "%09"), "-" if page is None else "=" + page, archive, str(offset), str(length)))


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes sorted lines in compressed blocks; returns the stored directory: first_key, last_key,
    file, offset, length, lines, in the order of keys."""
    def write(batches):
        from pyspark import TaskContext
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        context, out, at, held = TaskContext.get(), None, 0, []
        name = f"index-{context.partitionId():06d}-{context.taskAttemptId()}.gz"

        def block():
            nonlocal out, at
            if out is None:
                out = files.open_output_stream(f"{root}/{name}", compression=None)
            lines = held[:block_lines]
            del held[:block_lines]
            data = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
            out.write(data)
            row = {"first_key": [lines[0].split("\t", 1)[0]], "last_key": [lines[-1].split("\t", 1)[0]], "file": [name], "offset": [at], "length": [len(data)], "lines": [len(lines)]}
            at += len(data)
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            held += [line_of(*row) for row in zip(*(batch.column(c).to_pylist() for c in range(5)))]
            while len(held) >= block_lines:
                yield block()
        if held:
            yield block()
        if out is not None:
            out.close()
    ordered = captures.withColumn("key", F.replace(F.col("key"), F.lit("\t"), F.lit("%09"))).repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return stored(ordered.mapInArrow(write, "first_key string, last_key string, file string, offset long, length long, lines long"), "op9-directory")


def block_lines_of(files, root: str, name: str, offset: int, length: int) -> list[str]:
    with files.open_input_file(f"{root}/{name}") as source:
        source.seek(offset)
        return gzip.decompress(source.read(length)).decode().split("\n")


def capture_rows(directory: DataFrame, folder: str) -> DataFrame:
    """key, page_id, archive, offset, length of all captures, from the blocks."""
    def read(batches):
        files, root = file_system(folder)
        for batch in batches:
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in range(3))):
                cells = [line.split("\t") for line in block_lines_of(files, root, name, offset, length)]
                yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells]), pa.array([None if c[1] == "-" else c[1][1:] for c in cells], pa.string()), pa.array([c[2] for c in cells]),
                                                  pa.array([int(c[3]) for c in cells], pa.int64()), pa.array([int(c[4]) for c in cells], pa.int64())],
                                                 ["key", "page_id", "archive", "offset", "length"])
    return directory.select("file", "offset", "length").repartition("file", "offset").mapInArrow(read, "key string, page_id string, archive string, offset long, length long")


RECORD = "key string, page_id string, record_type string, refers_to string, payload_bytes long, payload_digest string"


def read_records(captures: DataFrame, folder: str, chunk: int = 1 << 22) -> DataFrame:
    """Reads each capture's range and checks it. payload_bytes and payload_digest are those of the
    full payload: computed from the bytes of a response, taken from the headers of a revisit."""
    def read(batches):
        files, root = file_system(folder)
        name, source = None, None
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("key", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")}
            for key, page, archive, offset, length in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, files.open_input_file(f"{root}/{archive}")
                source.seek(offset)
                warc, http, payload = parsed(gzip.decompress(source.read(length)))
                told = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                if warc["WARC-Type"] == "response":
                    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    if digest != told:
                        raise ValueError(f"payload of {warc['WARC-Record-ID']} differs from its digest")
                else:
                    digest, size = told, int(http["Content-Length"])
                for c, v in zip(out, (key, page, warc["WARC-Type"], warc.get("WARC-Refers-To-Page"), size, digest)):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.int64() if c == "payload_bytes" else pa.string()) for c in out], list(out))
        if source is not None:
            source.close()
    # runs of an archive's bytes, so that a large archive is read by several tasks
    dealt = captures.repartition("archive", F.floor(F.col("offset") / chunk)).sortWithinPartitions("archive", "offset")
    return dealt.select("key", "page_id", "archive", "offset", "length").mapInArrow(read, RECORD)


def lookup(urls: DataFrame, directory: DataFrame, index_folder: str, archive_folder: str, url_col: str = "url",
           most_blocks: int = 1_000_000) -> DataFrame:
    """The records of the given urls (all captures of each): binary search in the directory, then in
    the block, then a range read. The directory has one row for `block_lines` captures and is sent to the
    tasks; a directory beyond `most_blocks` rows is refused (look such an archive up folder by folder)."""
    key = F.udf(url_key, "string")
    asked = urls.select(key(F.col(f"`{url_col}`")).alias("key")).distinct()
    if directory.limit(most_blocks + 1).count() > most_blocks:
        raise ValueError("split the index folder: a directory holds at most most_blocks rows")
    rows = [tuple(r) for r in directory.orderBy("first_key", "last_key", "file", "offset").collect()]
    shared = urls.sparkSession.sparkContext.broadcast(rows)

    def find(batches):
        files, root = file_system(index_folder)
        blocks = shared.value
        lasts = [b[1] for b in blocks]  # sorted as the first keys are
        for batch in batches:
            found: list[tuple] = []
            for wanted in sorted(batch.column(0).to_pylist()):
                at = bisect.bisect_left(lasts, wanted)
                while at < len(blocks) and blocks[at][0] <= wanted:
                    lines = block_lines_of(files, root, blocks[at][2], blocks[at][3], blocks[at][4])
                    k = bisect.bisect_left(lines, wanted + "\t")
                    while k < len(lines) and lines[k].startswith(wanted + "\t"):
                        found.append(tuple(lines[k].split("\t")))
                        k += 1
                    at += 1
            yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in found], pa.string()), pa.array([None if c[1] == "-" else c[1][1:] for c in found], pa.string()), pa.array([c[2] for c in found], pa.string()),
                                              pa.array([int(c[3]) for c in found], pa.int64()), pa.array([int(c[4]) for c in found], pa.int64())],
                                             ["key", "page_id", "archive", "offset", "length"])
    captures = asked.mapInArrow(find, "key string, page_id string, archive string, offset long, length long")
    return read_records(captures, archive_folder)


def build(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
          block_lines: int = BLOCK_LINES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes archives to folder/archives and the index to folder/index; returns the directory."""
    captures = write_archives(with_revisits(pages, id_col, url_col, html_col), f"{folder}/archives", archive_bytes)
    return write_index(captures, f"{folder}/index", block_lines)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page, read back from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload. Of equal long payloads, a row with a null id is a revisit
    while another has an id; rows that repeat the largest id are each a response. A null url has
    an empty key.
    """
    spark: SparkSession = pages.sparkSession
    folder = scratch_path(spark, "op9-warc")
    directory = build(pages, folder, id_col, url_col, html_col)
    records = read_records(capture_rows(directory, f"{folder}/index"), f"{folder}/archives")
    kind = pages.schema[id_col].dataType.simpleString()
    return records.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
