"""Web archives of individually compressed records that share a dictionary.

An archive file is a sequence of Zstandard frames: first a skippable frame that
holds the dictionary, then one frame per WARC record. The dictionary is trained
on a bounded sample of the records (``SAMPLE_RECORDS`` pages with the smallest
hash, ``SAMPLE_BYTES`` at most, none above ``SAMPLE_PAGE_BYTES``), filled up with
the headers of empty pages where there are few; every record is written, and every
file leads with the dictionary. Spark's text writer stores the frames, so that
files appear under Spark's commit protocol in any store that Spark reaches. Its
line separator is a skippable frame with a name drawn at random when the archive is
written: no payload can quote it, and any reader of the format skips it. The first
of them follows the dictionary, where the reader of the folder looks it up. A folder
holds the archive files of one run of the writer.

Of the pages with one payload the one with the largest id is a response and the
others are revisits that refer to it.

Defined results: a null payload counts as empty; null addresses are left out,
line breaks in them are percent-encoded; rows that share the largest id of a
payload are all responses; a null id is never the largest, and where no id is
known every row is a response. An empty table gives an archive without records,
a payload of any length one record. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import secrets
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup.llm.common import fresh_name, steps, text_or_empty
from neardup.session import hadoop_path, materialize, scratch_path

SAMPLE_RECORDS, SAMPLE_BYTES, SAMPLE_PAGE_BYTES = 1500, 8 << 20, 1 << 20
#: Records of empty pages that small samples are filled up with.
FILLING_RECORDS = 256
DICTIONARY_BYTES = 112_640
LEVEL = 3

# Fixed values of the formats: magic numbers of skippable frames, record fields.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
SEPARATOR_MAGIC, NAME_BYTES = b"\x50\x2a\x4d\x18", 16
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit where ``refers_to`` names another page."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        clean = url.replace("\r", "%0D").replace("\n", "%0A")
        fields.append(f"WARC-Target-URI: {clean}")
    if page_id is not None:
        fields.append(f"X-Page-ID: {page_id}")
    fields.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if refers_to is not None:
        fields += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Fields of a record; raises where lengths or digests do not hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    block, end = rest[:n], rest[n:]
    if not version.startswith("WARC/") or len(block) != n or end != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")]
    size = int(sizes[0].split(":")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")

    def page(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    return {
        "page_id": page("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("X-Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


# --- dictionaries and frames -----------------------------------------------


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples, and of headers where the samples are few."""
    if len(samples) < FILLING_RECORDS or sum(map(len, samples)) < 8 * DICTIONARY_BYTES:
        empty = (build_record(i, f"https://host/{i}", b"", None) for i in range(FILLING_RECORDS))
        samples = [*samples, *empty]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    return zstandard.train_dictionary(size, samples).as_bytes()


def skippable(magic: bytes, content: bytes) -> bytes:
    return magic + len(content).to_bytes(4, "little") + content


def draw_separator(dictionary: bytes) -> bytes:
    """A skippable frame with a random name that the dictionary does not contain."""
    while True:
        separator = skippable(SEPARATOR_MAGIC, secrets.token_hex(NAME_BYTES // 2).encode())
        if separator not in dictionary:
            return separator


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary)
    return zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True)


def compress_record(
    record: bytes, compressors: list[zstandard.ZstdCompressor], separator: bytes
) -> bytes:
    """A frame without the separator's bytes in it.

    The name in the separator has 64 random bits and is drawn after the records
    are there, so a frame has it by chance alone; another level is tried then.
    """
    for c in compressors:
        frame = c.compress(record)
        if separator not in frame:
            return frame
    raise ValueError("no level gives a frame without the separator; write the archive again")


def sample_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> list[bytes]:
    """Records of the pages with the smallest hash, within the bounds of the sample."""
    place = F.xxhash64(id_col, url_col, payload_col)
    size = F.octet_length(payload_col)
    narrow = pages.where(size <= SAMPLE_PAGE_BYTES).select(place.alias("h"), size.alias("size"))
    chosen = narrow.distinct().orderBy("h").limit(SAMPLE_RECORDS).toArrow().sort_by("h")
    kept, total = [], 0
    for h, size_of in zip(chosen["h"].to_pylist(), chosen["size"].to_pylist()):
        total += size_of
        if total > SAMPLE_BYTES:
            break
        kept.append(h)
    if not kept:
        return []
    # Repeated rows share a hash, so that one row comes for each one chosen.
    rows = pages.where((place <= kept[-1]) & (size <= SAMPLE_PAGE_BYTES))
    rows = rows.select(id_col, url_col, payload_col).distinct().limit(len(kept)).toArrow()
    columns = (c.to_pylist() for c in rows.columns)
    return sorted(build_record(i, u, p.encode(), None) for i, u, p in zip(*columns))


# --- writer and reader -----------------------------------------------------


def with_keepers(pages: DataFrame, id_col: str, payload_col: str, keeper_col: str) -> DataFrame:
    """Adds the largest id of the pages with the same payload.

    Digests are counted first; only those of several pages meet their pages,
    in a join that adaptive execution can split.
    """
    key = [fresh_name(pages, "_digest"), fresh_name(pages, "_bytes")]
    digest = [F.sha2(payload_col, 256), F.octet_length(payload_col)]
    narrow = pages.select(F.col(id_col).alias("_id"), *[d.alias(k) for d, k in zip(digest, key)])
    several = narrow.groupBy(*key).agg(F.max("_id").alias(keeper_col), F.count(F.lit(1)).alias("_n"))
    several = materialize(several.where("_n > 1").drop("_n"), "same-payloads")
    keyed = pages.withColumns(dict(zip(key, digest)))
    return keyed.join(several, key, "left").drop(*key)


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    level: int = LEVEL,
) -> None:
    """One record per row into archive files below ``path``, one file per task."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        text_or_empty(payload_col).alias("payload"),
    )
    dictionary = train_dictionary(sample_records(rows, "page_id", "url", "payload"))
    separator = draw_separator(dictionary)
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)
    kept = with_keepers(rows, "page_id", "payload", "keeper")

    def frames(batches):
        compressors = [_compressor(shared.value, x) for x in (level, level + 1, level + 2, level + 3)]
        begun = False
        for batch in batches:
            sizes = pc.binary_length(batch.column("payload")).to_pylist()
            for a, b in steps(sizes):
                out = []
                if not begun:
                    out.append(skippable(DICTIONARY_MAGIC, shared.value))
                begun = True
                columns = (c.to_pylist() for c in batch.slice(a, b - a).columns)
                for page, url, payload, keeper in zip(*columns):
                    revisits = keeper if keeper is not None and keeper != page else None
                    record = build_record(page, url, payload.encode(), revisits)
                    out.append(compress_record(record, compressors, separator))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    written = kept.select("page_id", "url", "payload", "keeper").mapInArrow(frames, "value binary")
    (
        written.select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", separator.decode("ascii"))
        .text(path)
    )


def read_head(spark: SparkSession, path: str) -> tuple[bytes, bytes] | None:
    """The dictionary and the separator of the archives below ``path``; None without records.

    Every file leads with both; the first bytes of one file are read.
    """
    fs, folder = hadoop_path(spark, path)
    files = fs.listFiles(folder, False)
    while files.hasNext():
        file = files.next()
        if file.getLen() == 0 or file.getPath().getName()[0] in "._":
            continue
        stream = fs.open(file.getPath())
        try:
            read = spark._jvm.org.apache.commons.io.IOUtils.toByteArray
            lead = bytes(read(stream, 8))
            if lead[:4] != DICTIONARY_MAGIC:
                raise ValueError(f"{file.getPath()} does not lead with a dictionary")
            dictionary = bytes(read(stream, int.from_bytes(lead[4:], "little")))
            separator = bytes(read(stream, 8 + NAME_BYTES))
        finally:
            stream.close()
        if separator[:4] != SEPARATOR_MAGIC:
            raise ValueError(f"{file.getPath()} has no separator after its dictionary")
        if dictionary[:4] == FRAME_MAGIC:  # the format allows a compressed dictionary
            dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        return dictionary, separator
    return None


def read_frames(spark: SparkSession, path: str, separator: bytes) -> DataFrame:
    """The frames of all archives below ``path``, as bytes."""
    lines = spark.read.option("lineSep", separator.decode("ascii")).text(path)
    return lines.select(F.col("value").cast("binary").alias("frame")).where("length(frame) > 0")


RECORD_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``; lengths and digests are checked."""
    head = read_head(spark, path)
    if head is None:
        return spark.createDataFrame([], RECORD_SCHEMA)
    dictionary, separator = head
    frames = read_frames(spark, path, separator)
    shared = spark.sparkContext.broadcast(dictionary)
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def records(batches) -> Iterator[pa.RecordBatch]:
        own = zstandard.ZstdCompressionDict(shared.value)
        reader = zstandard.ZstdDecompressor(dict_data=own)
        for batch in batches:
            for a, b in steps(pc.binary_length(batch.column(0)).to_pylist(), 1 << 18):
                out = []
                for frame in batch.column(0).slice(a, b - a).to_pylist():
                    if frame[:4] != FRAME_MAGIC:
                        continue
                    out.append(parse_record(reader.decompress(frame)))
                columns = [pa.array([r[n] for r in out], t) for n, t in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return frames.mapInArrow(records, RECORD_SCHEMA)


def archive_and_read(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages to ``path`` (scratch if not given) and reads the records back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archive(pages, path)
    return read_archive(spark, path)
