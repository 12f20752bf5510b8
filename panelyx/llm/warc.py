"""WARC archives as a Spark data source (operator 13): one gzip member per record, written and read in sequence.

``df.write.format("warc").save(folder)`` writes an archive per task; ``spark.read.format("warc").load(folder)`` reads every
archive with incremental zlib decompression: members one after the other, in pieces of ``PIECE`` bytes, records framed by their
Content-Length. A response's payload is hashed as it streams by and compared with the digest in its header; a wrong digest, a
length that its member does not have, or a cut archive stops the read with an error that names archive and record. The reader
holds one record at a time (with ``payload`` set to ``false`` one piece of it), and hands on batches of bounded bytes.

Writing follows Spark's commit: a task writes under a name of its own attempt, the driver renames the archives of the tasks
that count, so repeated and lost tasks leave nothing. Folders may be in any store that pyarrow opens by its address (local,
hdfs, s3, gs); on a cluster one that all executors share.

Records with equal payloads of at least ``LEAST_BYTES`` are one response and revisits, which hold only the HTTP header and
point to the response (:func:`marked`). Equality is that of SHA-256 digest and length. Groups meet over salts of the
address and id, so that a page that a third of all rows repeat is spread.

Defined results: a null html is an empty payload; a null url gives no target; a null page_id loses to any other and comes back as
null; rows that repeat a page_id with one payload are all responses if the id is the smallest; control characters and spaces
of an address are written in percent form; an empty table gives an empty result; columns besides the three are ignored,
whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import opened, read, shared_checkpoints, shuffle_partitions, small_batches

LEAST_BYTES = 100
PIECE = 1 << 18
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2_000
#: Fixed values of the format: version line, media types, profile of a revisit.
VERSION = b"WARC/1.1"
HTTP_TYPE = "application/http;msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"
SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


class ArchiveError(ValueError):
    """An archive that does not hold what its headers say."""


def _address(url: str | None) -> str | None:
    return None if url is None else "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _record_id(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.strip("<>").removeprefix(_ID)
    return int(number) if number else None


def record(page_id: int | None, url: str | None, record_type: str, refers_to: int | None, length: int, digest: str, payload: bytes, date: str) -> tuple[bytes, bytes]:
    """Header and block of a record; the payload of a revisit is not in its block, its length stays in the HTTP header."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http if record_type == "revisit" else http + payload
    fields = [("WARC-Type", record_type), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _address(url) or ""))
    if record_type == "revisit":
        fields += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n", block


def member(*parts: bytes, level: int = 6) -> bytes:
    """One gzip member; the same bytes give the same member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join([*(packer.compress(p) for p in parts), packer.flush()])


class _Members:
    """Pieces of the members of an archive; only the member at hand is open, and only a piece of it is held."""

    def __init__(self, stream, name: str) -> None:
        self.stream, self.name, self.rest = stream, name, b""

    def next(self) -> Iterator[bytes] | None:
        """The pieces of the next member, to be read to their end before the one after; None behind the last."""
        if not self.rest:
            self.rest = self.stream.read(PIECE)
        return self._pieces() if self.rest else None

    def _pieces(self) -> Iterator[bytes]:
        unpacker, full = zlib.decompressobj(31), False
        while not unpacker.eof:
            if not self.rest and not full:  # a full piece may leave more to come without further input
                self.rest = self.stream.read(PIECE)
                if not self.rest:
                    raise ArchiveError(f"{self.name}: cut inside a record")
            try:
                piece = unpacker.decompress(self.rest, PIECE)
            except zlib.error as error:
                raise ArchiveError(f"{self.name}: {error}") from error
            full = len(piece) == PIECE
            self.rest = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
            if piece:
                yield piece


class _Framed:
    """A member as lines and counted bytes."""

    def __init__(self, pieces: Iterator[bytes], where: str) -> None:
        self.pieces, self.where, self.held = pieces, where, b""

    def _more(self) -> None:
        piece = next(self.pieces, None)
        if piece is None:
            raise ArchiveError(f"{self.where}: shorter than its Content-Length")
        self.held += piece

    def head(self) -> tuple[str, dict[str, str]]:
        """First line and fields (names in lower case) up to the empty line."""
        while b"\r\n\r\n" not in self.held:
            self._more()
        head, _, self.held = self.held.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8", "replace").split("\r\n")
        fields: dict[str, str] = {}
        name = ""
        for line in lines:
            if line[:1] in (" ", "\t") and name:  # a folded line goes on with the field before
                fields[name] += " " + line.strip()
                continue
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
        return first, fields

    def counted(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            if not self.held:
                self._more()
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            yield piece

    def ends(self) -> None:
        """Two line ends close the record, and nothing comes after them."""
        rest = self.held + b"".join(self.pieces)
        if rest != b"\r\n\r\n":
            raise ArchiveError(f"{self.where}: longer than its Content-Length")


def _digest_of(field: str) -> tuple[str, bytes]:
    """Algorithm and bytes of a labelled digest, in hex or in base 32."""
    label, _, value = field.partition(":")
    made = hashlib.new(label.replace("-", "").lower())
    plain = len(value) == 2 * made.digest_size
    return made.name, bytes.fromhex(value) if plain else base64.b32decode(value.upper() + "=" * (-len(value) % 8))


def _number(fields: dict[str, str], name: str, where: str) -> int:
    value = fields.get(name, "")
    if not value.isdigit():
        raise ArchiveError(f"{where}: no {name}")
    return int(value)


def records(stream, name: str, *, payload: bool = True) -> Iterator[tuple]:
    """Rows of SCHEMA from an archive, in its order; records that are neither response nor revisit are passed over."""
    members = _Members(stream, name)
    number = 0
    while (pieces := members.next()) is not None:
        number += 1
        framed = _Framed(pieces, f"{name}, record {number}")
        version, fields = framed.head()
        if not version.startswith("WARC/"):
            raise ArchiveError(f"{framed.where}: starts with {version[:20]!r}")
        block = framed.counted(_number(fields, "content-length", framed.where))
        kind = fields.get("warc-type", "")
        if kind not in ("response", "revisit"):
            for _ in block:
                pass
            framed.ends()
            continue
        whole = hashlib.new(_digest_of(fields["warc-block-digest"])[0]) if "warc-block-digest" in fields else None

        def watched(block=block, whole=whole) -> Iterator[bytes]:
            for piece in block:
                if whole:
                    whole.update(piece)
                yield piece

        inner = _Framed(watched(), framed.where)
        _, http = inner.head()
        length = _number(http, "content-length", framed.where)
        algorithm, expected = _digest_of(fields.get("warc-payload-digest", ""))
        kept: list[bytes] = []
        if kind == "response":
            made = hashlib.new(algorithm)
            for piece in inner.counted(length):
                made.update(piece)
                if payload:
                    kept.append(piece)
            if made.digest() != expected:
                raise ArchiveError(f"{framed.where}: payload and digest differ")
        if inner.held or next(inner.pieces, b""):
            raise ArchiveError(f"{framed.where}: block and HTTP length differ")
        if whole and whole.digest() != _digest_of(fields["warc-block-digest"])[1]:
            raise ArchiveError(f"{framed.where}: block and digest differ")
        framed.ends()
        refers = _page_id(fields["warc-refers-to"]) if kind == "revisit" else None
        yield _page_id(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, refers, length, expected.hex(), b"".join(kept) if payload and kind == "response" else None


@dataclass
class _Archive(InputPartition):
    path: str


@dataclass
class _Written(WriterCommitMessage):
    path: str
    rows: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema) -> None:
        self.folder, self.payload, self.schema = options["path"], options.get("payload", "true").lower() != "false", schema

    def partitions(self) -> list[InputPartition]:
        fs, path = opened(self.folder)
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True)) if fs.get_file_info(path).type == pafs.FileType.Directory else [fs.get_file_info(path)]
        return [_Archive(f.path) for f in sorted(found, key=lambda f: -(f.size or 0)) if f.type == pafs.FileType.File and f.path.endswith(".warc.gz")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, _Archive):  # no archive at all
            return
        from pyspark.sql.pandas.types import to_arrow_schema

        names, schema = [c.split()[0] for c in SCHEMA.split(", ")], to_arrow_schema(self.schema)
        fs, _ = opened(self.folder)
        held: list[tuple] = []
        octets = 0

        def batch() -> pa.RecordBatch:
            columns = dict(zip(names, zip(*held, strict=True), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

        with fs.open_input_stream(partition.path, compression=None) as stream:
            for row in records(stream, posixpath.basename(partition.path), payload=self.payload):
                held.append(row)
                octets += len(row[-1] or b"") + 100
                if octets >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                    yield batch()
                    held.clear()
                    octets = 0
        if held:
            yield batch()


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.folder, self.date, self.overwrite = options["path"], options.get("date", "1970-01-01T00:00:00Z"), overwrite
        self.waiting = f"_waiting-{uuid.uuid4().hex}"  # this job's own

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, folder = opened(self.folder)
        waiting = posixpath.join(folder, self.waiting)
        fs.create_dir(waiting, recursive=True)
        path = posixpath.join(waiting, f"{uuid.uuid4().hex}.warc.gz")
        rows = 0
        with fs.open_output_stream(path, compression=None) as out:
            for batch in iterator:
                columns = {n: batch.column(n) for n in batch.schema.names}
                for i in range(batch.num_rows):
                    row = {n: c[i].as_py() for n, c in columns.items()}
                    head, block = record(row["page_id"], row["url"], row["record_type"], row["refers_to"], row["payload_bytes"], row["payload_digest"], row["payload"] or b"", self.date)
                    out.write(member(head, block, b"\r\n\r\n"))
                    rows += 1
        return _Written(path, rows)

    def commit(self, messages: list) -> None:
        fs, folder = opened(self.folder)
        waiting = posixpath.join(folder, self.waiting)
        fs.create_dir(folder, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
                if f.type == pafs.FileType.File and f.path.endswith(".warc.gz"):
                    fs.delete_file(f.path)
        for m in messages:
            if m is not None and m.rows:
                fs.move(m.path, posixpath.join(folder, posixpath.basename(m.path)))
        if fs.get_file_info(waiting).type == pafs.FileType.Directory:
            fs.delete_dir(waiting)

    def abort(self, messages: list) -> None:
        fs, folder = opened(self.folder)
        waiting = posixpath.join(folder, self.waiting)
        if fs.get_file_info(waiting).type == pafs.FileType.Directory:
            fs.delete_dir(waiting)


class WarcDataSource(DataSource):
    """Options: path; reading: payload ('false' leaves payloads out); writing: date (WARC-Date of all records)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def marked(pages: DataFrame, *, least_bytes: int = LEAST_BYTES, salts: int | None = None) -> DataFrame:
    """Columns of SCHEMA for every row of pages: who is a response, who a revisit of which page. Native operations only."""
    salts = salts or 4 * shuffle_partitions(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int").alias("salt"))
    key = ["payload_digest", "payload_bytes"]
    salted = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy(*key, "salt").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = salted.groupBy(*key).agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    firsts = salted.select(*key, "salt").join(groups, key)
    joined = rows.join(firsts, [*key, "salt"], "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    return joined.select("page_id", "url", kind.alias("record_type"), F.when(again, F.col("first")).alias("refers_to"), "payload_bytes", "payload_digest", F.when(~again, F.col("payload")).alias("payload"))


def write(pages: DataFrame, folder: str, **options) -> None:
    """Archives of pages in a folder that driver and executors share."""
    register(pages.sparkSession)
    small_batches(pages.sparkSession, 200)
    marked(pages, **options).write.format("warc").mode("append").save(folder)


def load(spark: SparkSession, folder: str, *, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def checked(archived: DataFrame, *, salts: int | None = None) -> DataFrame:
    """archived; the job stops where a revisit's response is missing or has another digest or length.

    A response goes to as many salts as there are, so that the revisits of one page are spread.
    """
    salts = salts or shuffle_partitions(archived.sparkSession)
    key = ["payload_digest", "payload_bytes"]
    revisits = archived.filter("record_type = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    asked = revisits.select("refers_to", *key, "salt").distinct()
    there = archived.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), *key, F.lit(True).alias("there")).distinct()
    answered = asked.join(there, ["refers_to", *key], "left")
    found = revisits.join(answered, ["refers_to", *key, "salt"], "left")
    proven = F.when(F.coalesce("there", F.lit(False)), F.col("record_type")).otherwise(F.raise_error(F.lit("a revisit without its response")).cast("string"))
    columns = [c for c in archived.columns if c != "record_type"]
    return archived.filter("record_type = 'response'").select(*columns, "record_type").unionByName(found.select(*columns, proven.alias("record_type")))


def restored(archived: DataFrame, *, salts: int | None = None) -> DataFrame:
    """page_id, url, html of every record; revisits take the payload of their response, over salts."""
    salts = salts or shuffle_partitions(archived.sparkSession)
    key = ["payload_digest", "payload_bytes"]
    revisits = archived.filter("record_type = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    asked = revisits.select("refers_to", *key, "salt").distinct()
    responses = archived.filter("record_type = 'response'")
    # rows that repeat the smallest id are equal: any one of them serves
    sources = responses.select(F.col("page_id").alias("refers_to"), *key, "payload").dropDuplicates(["refers_to", *key])
    taken = revisits.drop("payload").join(asked.join(sources, ["refers_to", *key]), ["refers_to", *key, "salt"])
    both = responses.select("page_id", "url", "payload").unionByName(taken.select("page_id", "url", "payload"))
    return both.select("page_id", "url", F.col("payload").cast("string").alias("html"))


def query(spark, sf_dir: str) -> DataFrame:
    shared_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    write(read(spark, sf_dir, "pages"), folder)
    return checked(load(spark, folder, payload=False)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
