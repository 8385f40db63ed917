"""WARC archives: an index written with the records, then coalesced byte-range reads."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrove.llm.common import join_facts, materialise, new_path

DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, record_type string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def with_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): the smallest id of each equal payload, where another has it.

    Payloads of fewer than `min_bytes` bytes refer to nothing.  Equality is told by SHA-1,
    length and a 64-bit hash; counts are pre-aggregated before the join, and payloads aren't
    shuffled where few of them are shared, nor those that very many pages share.  A row that repeats the smallest id, or whose group
    has null ids alone, refers to nothing.
    """
    text = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), text.alias("payload")).withColumns(
        {"h1": F.unhex(F.sha1("payload")), "h2": F.xxhash64("payload"), "size": F.octet_length("payload")}
    )
    key = ["h1", "h2", "size"]
    groups = rows.filter(F.col("size") >= min_bytes).groupBy(*key).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies, _ = materialise(groups.filter("n > 1 AND first IS NOT NULL"), "warc-copies")
    total = copies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return join_facts(rows, copies, key, "n", total, "left").select("page_id", "url", F.encode("payload", "UTF-8").alias("payload"), refers.alias("refers_to"))


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(uri: str) -> int | None:
    value = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return None if value == "null" else int(value)


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record.  A revisit has the HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        # control characters and spaces can't stand in a header line
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record; a response whose payload belies its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no WARC record: {first[:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (size != len(payload) or digest_of(payload) != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        "payload": payload if kind == "response" else None,
    }


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, **columns) -> DataFrame:
    """Write a record per row to `.warc.gz` files, each record its own gzip member, and the index.

    The index has, per record, its file, the offset and length of its bytes, its URL and its
    digest.  File names hold a part that no other attempt of a task shares, and the committed
    index names the files of the attempts that counted.  Null html is an empty payload, null
    urls and ids are kept; an empty table gives an empty index.
    """
    spark = pages.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, offset = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            if out is None:
                system, path = fs.FileSystem.from_uri(f"{folder}/{name}")
                system.create_dir(path.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(path, compression=None)
            rows = []
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest = digest_of(payload)
                packer = zlib.compressobj(4, wbits=31)
                data = packer.compress(build_record(page_id, url, payload, digest, refers_to)) + packer.flush()
                out.write(data)
                rows.append((page_id, url, name, offset, len(data), digest, "response" if refers_to is None else "revisit"))
                offset += len(data)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in INDEX.split(", ")])
        if out is not None:
            out.close()

    with_revisits(pages, min_bytes, **columns).mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def coalesce_ranges(rows: Iterable[tuple[str, int, int]], max_gap: int, max_bytes: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Ranges (file, begin, end, [(offset, length)]) that cover sorted records.

    A record joins the range before it if at most `max_gap` bytes lie between and the range
    stays within `max_bytes`.
    """
    held = None
    for file, offset, length in rows:
        if held and file == held[0] and offset - held[2] <= max_gap and offset + length - held[1] <= max_bytes:
            held[3].append((offset, length))
            held[2] = max(held[2], offset + length)
        else:
            if held:
                yield tuple(held)
            held = [file, offset, offset + length, [(offset, length)]]
    if held:
        yield tuple(held)


def read_records(index: DataFrame, folder: str, max_gap: int = 65_536, max_bytes: int = 8_388_608, task_bytes: int = 33_554_432) -> DataFrame:
    """Read the records that ``index`` selects: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The selected rows are sorted by file and offset over the whole cluster; each task then
    reads few long ranges instead of one range per record.  There is a task for each
    `task_bytes` of records, and a batch of records goes on once it holds `max_bytes` inflated.
    """
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORD.split(", ")]

    def batch_of(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], k) for c, k in zip(names, kinds, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            wanted = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for file, begin, end, records in coalesce_ranges(wanted, max_gap, max_bytes):
                if file != name:
                    if source is not None:
                        source.close()
                    system, path = fs.FileSystem.from_uri(f"{folder}/{file}")
                    name, source = file, system.open_input_file(path)
                data = source.read_at(end - begin, begin)
                found, held = [], 0
                for o, n in records:
                    found.append(parse_record(zlib.decompress(data[o - begin : o - begin + n], wbits=31)))
                    held += len(found[-1]["payload"] or b"")
                    if held > max_bytes:
                        yield batch_of(found)
                        found, held = [], 0
                yield batch_of(found)
        if source is not None:
            source.close()

    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // task_bytes))
    places = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInArrow(read, RECORD)


def archive_table(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read all of them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = folder or new_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, min_bytes), folder).drop("url", "payload")
