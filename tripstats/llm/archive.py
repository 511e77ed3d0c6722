"""Content-addressed web archive.

An archive is two tables in one folder.  ``payloads`` holds the bytes of each distinct payload
once, under its SHA-256.  ``records`` holds the exact header of each WARC record with the
address of its payload.  Records are rebuilt by joining the two, and written as WARC files, which
are read back record by record.
"""

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The header of a record.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "1970-01-01T00:00:00Z"
NEW_LINE = "\r\n"

# Smaller payloads are stored once as well, but their records are no revisits.
LEAST_REVISIT_BYTES = 1000

# WARC files are read whole by one task: a file takes about so many bytes of payload.
FILE_BYTES = 128 << 20
# Payload that a task hands on at a time.
_STEP_BYTES = 4 << 20

_READ = """page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string,
  header string, payload binary"""


def write_archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = LEAST_REVISIT_BYTES,
) -> None:
    """Write one record a row to the folder ``path``.

    A null payload is empty, a null url gives a header without target.  Of equal payloads of
    ``least_bytes`` or more the record with the largest id is the response; the others
    refer to it.  Rows with the same id and payload are all responses if that id is
    the largest.  Rows without an id are refused.  Other columns are not stored.
    """
    rows = pages.select(
        F.when(F.col(page_id).isNull(), F.raise_error(F.lit("a page has no id")))
        .otherwise(F.col(page_id))
        .alias("page_id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"address": F.sha2("payload", 256), "n_bytes": F.length("payload").cast("long")})
    # Copies meet in each task first, so a payload with most of the pages sends few rows.
    contents = rows.groupBy("address").agg(
        F.any_value("payload").alias("payload"),
        F.max("n_bytes").alias("n_bytes"),
        F.min("n_bytes").alias("_least"),
        F.max("page_id").alias("response_id"),
        F.min(F.xxhash64("payload")).alias("_check"),
        F.max(F.xxhash64("payload")).alias("_check_too"),
    )
    collides = (F.col("n_bytes") != F.col("_least")) | (F.col("_check") != F.col("_check_too"))
    contents = contents.select(
        F.when(collides, F.raise_error(F.lit("two payloads share a digest")))
        .otherwise(F.col("address"))
        .alias("address"),
        "n_bytes",
        F.sha1("payload").alias("sha1"),
        "response_id",
        "payload",
    )
    (
        contents.write.option("compression", "zstd")
        .option("parquet.page.size.row.check.min", 8)
        .parquet(f"{path}/payloads")
    )
    known = _payloads(pages.sparkSession, path).drop("payload")
    heads = rows.select("page_id", "url", "address").join(known, "address")
    is_revisit = (F.col("n_bytes") >= least_bytes) & (F.col("page_id") != F.col("response_id"))
    heads = heads.select(
        "page_id", "address", _header(is_revisit).alias("header")
    )
    heads.write.option("compression", "zstd").parquet(f"{path}/records")


def read_records(spark: SparkSession, path: str, of_revisits: bool = True) -> DataFrame:
    """Every record of the archive: page_id, header, payload (the full bytes, of revisits too, unless
    ``of_revisits`` is false).

    A payload that does not fit its address stops the job.
    """
    kept = _payloads(spark, path).select("address", "payload")
    fits = F.sha2("payload", 256) == F.col("address")
    checked = kept.select(
        "address",
        F.when(fits, F.col("payload"))
        .otherwise(F.raise_error(F.lit("a stored payload is damaged")))
        .alias("payload"),
    )
    heads = spark.read.schema("page_id long, address string, header string").parquet(
        f"{path}/records"
    )
    if of_revisits:
        return heads.join(checked, "address").select("page_id", "header", "payload")
    revisits = header_field("WARC-Type") == "revisit"
    rest = heads.where(revisits).select("page_id", "header", F.lit(None).cast("binary").alias("payload"))
    responses = heads.where(~revisits).join(checked, "address").select("page_id", "header", "payload")
    return responses.unionByName(rest)


def warc_bytes(records: DataFrame) -> DataFrame:
    """page_id and ``record``: the bytes of each record as they stand in a WARC file, without
    the payload of revisits."""
    revisit = header_field("WARC-Type") == "revisit"
    body = F.when(revisit, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    end = F.encode(F.lit(NEW_LINE * 2), "UTF-8")
    head = F.encode("header", "UTF-8")
    return records.select("page_id", F.concat(head, body, end).alias("record"))


def write_warc(records: DataFrame, path: str, compressed: bool = False, file_records: int | None = None) -> None:
    """WARC files of the records, one file a task, or several of ``file_records`` records each;
    gzip files if ``compressed``."""
    # The text writer puts the bytes of a string down as they are; a record ends in a line end.
    cut = F.expr("substring(record, 1, length(record) - 1)").cast("string")
    options = {"compression": "gzip" if compressed else "none", "maxRecordsPerFile": file_records or 0}
    warc_bytes(records).select(cut).write.options(**options).text(path)


def export_warc(spark: SparkSession, archive: str, path: str) -> None:
    """The archive as compressed WARC files of bounded size."""
    mean = _payloads(spark, archive).agg(F.avg("n_bytes")).first()[0] or 0
    # The header of a record is some hundred bytes.
    file_records = max(1, int(FILE_BYTES / (mean + 500)))
    write_warc(read_records(spark, archive, of_revisits=False), path, True, file_records)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of WARC files, plain or gzip: page_id, record_type, refers_to (the page a revisit
    refers to), payload_bytes, payload_digest (SHA-1 as the header gives it), header, and payload (null for revisits,
    which hold none, and without ``with_payload``).

    Files are split into records by their Content-Length.  A record that is cut short or does not end where
    that says, and a payload of a response that does not fit its digest, stop the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield from _batches(warc_records(content.as_buffer()), with_payload)

    content = spark.read.format("binaryFile").load(path).where("length > 0")
    return content.select("content").mapInArrow(run, _READ)


def full_payloads(records: DataFrame) -> DataFrame:
    """``records`` of ``read_warc`` with payload_bytes (and payload) of revisits taken from the response that they
    refer to.  A revisit without its response, or with another digest, stops the job."""
    same = ["refers_to", "payload_digest"]
    # A response that is there twice must not make two of its revisits.
    responses = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"),
        "payload_digest",
        F.col("payload_bytes").alias("_bytes"),
        F.col("payload").alias("_payload"),
    ).dropDuplicates(same)
    revisits = records.where("record_type = 'revisit'").join(responses, same, "left")
    missing = F.raise_error(F.lit("a revisit does not fit its response")).cast("long")
    revisits = revisits.withColumns(
        {"payload_bytes": F.coalesce("_bytes", missing), "payload": F.col("_payload")}
    )
    return records.where("record_type <> 'revisit'").unionByName(revisits.select(*records.columns))


def warc_records(content) -> Iterator[tuple[str, bytes]]:
    """(header, body) of each record of a WARC file's bytes."""
    raw = io.BytesIO(content)
    file = gzip.open(raw) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
    while True:
        line = file.readline()
        if not line:
            return
        if line.decode("latin-1") != VERSION + NEW_LINE:
            raise ValueError("a WARC record does not begin where the one before should end")
        lines, length = [line], None
        while line != NEW_LINE.encode():
            line = file.readline()
            if not line.endswith(NEW_LINE.encode()):
                raise ValueError("a WARC record is cut short")
            lines.append(line)
            name, _, value = line.partition(b":")
            if name.lower() == b"content-length":
                length = int(value)
        if length is None:
            raise ValueError("a WARC record has no length")
        body = file.read(length)
        if len(body) < length or file.read(4) != NEW_LINE.encode() * 2:
            raise ValueError("a WARC record does not end where its length says")
        yield b"".join(lines).decode(), body


def _batches(records: Iterator[tuple[str, bytes]], with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _READ.split(",")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    rows, held = [], 0

    def batch():
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for header, body in records:
        rows.append(_record(header, body, with_payload))
        held += len(body) + len(header)
        if held >= _STEP_BYTES:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def _record(header: str, body: bytes, with_payload: bool) -> tuple:
    lines = (line.partition(": ") for line in header.split(NEW_LINE)[1:])
    fields = {name.lower(): value for name, _, value in lines}
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
        raise ValueError("the payload of a WARC record does not fit its digest")
    page, refers = (_page(fields.get(name)) for name in ("warc-record-id", "warc-refers-to"))
    payload = body if with_payload and kind == "response" else None
    return page, kind, refers, len(body), digest, header, payload


def _page(urn: str | None) -> int | None:
    return None if urn is None else int(urn.removeprefix("<urn:page:").removesuffix(">"))


def header_field(name: str, header: str = "header") -> Column:
    """A field of the header; null if it has none."""
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"<urn:page:(-?\d+)>", 1).cast("long")


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    schema = "address string, n_bytes long, sha1 string, response_id long, payload binary"
    return spark.read.schema(schema).parquet(f"{path}/payloads")


def _header(is_revisit: Column) -> Column:
    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(NEW_LINE))

    def urn(page_id):
        return F.concat(F.lit("<urn:page:"), F.col(page_id).cast("string"), F.lit(">"))

    target = F.regexp_replace("url", r"[\r\n]", "")
    revisit = F.concat(
        line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn("response_id"))
    )
    return F.concat(
        F.lit(VERSION + NEW_LINE),
        line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")),
        F.when(target.isNull(), "").otherwise(line("WARC-Target-URI", target)),
        line("WARC-Date", F.lit(WARC_DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(is_revisit, revisit).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(is_revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit(NEW_LINE),
    )
