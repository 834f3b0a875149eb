"""WARC archives: writing with revisit records, and reading by boundary chains.

Writing: a page is a response record with its HTTP block. Of pages with equal payloads,
the one with the smallest page_id is the response and the others are revisit records that
name it and hold the HTTP header only. Records are UTF-8 text, so Spark's text writer
makes the archive files, of about ``FILE_BYTES`` each.

Reading: the text reader cuts archives at the record magic, in payloads too. Tasks emit
every place where a header can be read, with the place where that record would end.
Pointer jumping from the start of each file keeps the records that can be reached: every
round doubles the length of the jumps, so their number grows with the logarithm of the
records in a file. A payload that holds the magic is put together from its pieces.

Cases: a NULL html is an empty payload; a NULL url gives no target header; a NULL
page_id is kept as an empty id, is never named by a revisit and is read back as NULL;
rows that share the smallest page_id of a payload are all responses; line breaks in a url
are percent-encoded; no rows give an archive without records; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewise.session import materialize, shared_folder

FILE_BYTES = 16_000_000
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"

VERSION = "WARC/1.1"
MAGIC, END = f"{VERSION}\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of a SHA-1; 20 bits, five hex digits, make four letters."""
    digits = F.sha1(payload)

    def letters(part: int) -> list[Column]:
        bits = F.conv(F.substring(digits, 5 * part + 1, 5), 16, 10).cast("int")
        return [
            F.substr(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1))
            for shift in (15, 10, 5, 0)
        ]

    return F.concat(*[letter for part in range(8) for letter in letters(part)])


def _record_text() -> Column:
    """A record without its last line feed, which the text writer adds."""
    line = F.lit("\r\n")
    is_response = F.col("first").isNull()

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, line)

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        header("Content-Length", F.octet_length("payload").cast("string")),
        line,
        F.when(is_response, F.col("payload")).otherwise(F.lit("")),
    )
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        header("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        header("WARC-Date", F.lit(DATE)),
        F.coalesce(header("WARC-Target-URI", url), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(is_response, F.lit("")).otherwise(
            F.concat(
                header(
                    "WARC-Refers-To",
                    F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")),
                ),
                header("WARC-Profile", F.lit(PROFILE)),
            )
        ),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
    )
    with_block = head.alias("head"), http.alias("http")
    return F.struct(*with_block)


def write_archives(
    pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES
) -> None:
    """Write (page_id, url, html) as WARC files below ``folder``."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("payload"),
    ).withColumn("content", F.sha2("payload", 256))
    bytes_ = F.octet_length("payload")
    shared = materialize(
        rows.filter(bytes_ >= min_revisit_bytes)
        .groupBy("content")
        .agg(F.min("page_id").alias("response"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("response").isNotNull())
        .select(F.col("content").alias("same"), "response"),
        "shared-payloads",
    )
    size = rows.agg((F.avg(bytes_) + 4 * F.coalesce(F.stddev_pop(bytes_), F.lit(0.0)))).first()[0]
    records = max(1, int(FILE_BYTES / (1000 + (size or 0))))
    # Without a hint: few shared payloads are broadcast by their measured bytes, many are
    # sorted, and AQE splits the pages of a crowded payload.
    joined = rows.join(shared, F.col("content") == F.col("same"), "left").withColumn(
        "first",
        F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")),
    )
    parts = joined.select(_record_text().alias("r")).select("r.*")
    parts.select(
        F.concat(
            "head",
            F.lit("Content-Length: "),
            F.octet_length("http").cast("string"),
            F.lit("\r\n\r\n"),
            "http",
            F.lit("\r\n\r"),
        )
    ).write.option("maxRecordsPerFile", records).text(folder)


def _header(name: str) -> Column:
    """Value of a named field in ``head``, empty if it is not there."""
    return F.regexp_extract("head", f"(?im)^{name}:[ \\t]*([^\\r\\n]*)", 1)


def _page(field: Column) -> Column:
    return F.regexp_extract(field, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(file, split, row, text): what stands between two magics, in the order of the file.

    The text reader cuts at the magic wherever it is, and splits large files. A chunk belongs
    to the split of the file that it begins in.
    """
    text = spark.read.option("lineSep", MAGIC).option("pathGlobFilter", "part-*").text(folder)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("text"),
    )


def _payload_columns(block: Column) -> dict[str, Column]:
    """Size and digest of the payload behind the HTTP header of a block."""
    http = F.substring_index(block, END, 1)
    payload = F.when(
        F.contains(block, F.lit(END)), F.substr(block, F.char_length(http) + len(END) + 1)
    ).otherwise(block)
    return {
        "http": http,
        "size": F.octet_length(payload).cast("bigint"),
        "digest": base32_sha1(payload),
    }


def _with_starts(chunks: DataFrame, size: Column) -> DataFrame:
    """Adds ``start``, where the magic before a chunk begins in its file."""
    before = (
        Window.partitionBy("file").orderBy("split", "row").rowsBetween(Window.unboundedPreceding, -1)
    )
    ends = F.coalesce(F.sum(size + len(MAGIC)).over(before), F.lit(0)) - len(MAGIC)
    return chunks.withColumn("start", ends.cast("bigint"))


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Every magic behind which a header can be read, with the place where that record
    would end, and its payload's size and digest if it ends at the next magic."""
    chunks = _chunks(spark, folder).withColumn("head", F.substring_index("text", END, 1))
    length = _header("Content-Length").try_cast("bigint")
    rest = F.substr("text", F.char_length("head") + len(END) + 1)
    read = chunks.withColumns(
        {
            "bytes": F.octet_length("text").cast("bigint"),
            "length": F.when(F.contains("text", F.lit(END)), length),
            "head_bytes": F.octet_length("head").cast("bigint") + len(END),
            "kind": _header("WARC-Type"),
            "page_id": _page(_header("WARC-Record-ID")),
            "named": F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", ""),
            "refers_to": _page(_header("WARC-Refers-To")),
        }
    ).withColumn("alone", F.col("bytes") == F.col("head_bytes") + F.col("length") + len(END))
    # The block is the text behind the header without the closing line breaks.
    block = F.when(F.col("alone"), F.substr(rest, F.lit(1), F.char_length(rest) - len(END)))
    found = read.withColumn("block", block).withColumns(_payload_columns(F.col("block")))
    slim = found.select(
        "file", "split", "row", "bytes", "length", "head_bytes", "kind", "page_id", "named",
        "refers_to", "alone", "size", "digest",
        F.regexp_extract("http", "(?im)^Content-Length:[ \\t]*([0-9]+)", 1)
        .try_cast("bigint")
        .alias("http_length"),
    )
    placed = _with_starts(slim, F.col("bytes"))
    ends = F.col("start") + len(MAGIC) + F.col("head_bytes") + F.col("length") + len(END)
    return placed.withColumn("next", ends).filter(
        (F.col("start") >= 0) & F.col("length").isNotNull()
    )


def _reachable(candidates: DataFrame) -> DataFrame:
    """(file, start) that a chain of records from the file's start leads to.

    All joins sort. These tables pack so well that a small file may be a large broadcast.
    """
    jumps = materialize(candidates.select("file", "start", "next"), "record-jumps")
    reached = materialize(
        jumps.filter(F.col("start") == 0).select("file", "start"), "reached-records"
    )
    count = reached.count()
    while count:
        moved = reached.join(jumps.hint("merge"), ["file", "start"]).select(
            "file", F.col("next").alias("start")
        )
        # A place at the end of a file is no record.
        places = candidates.select("file", "start").hint("merge")
        landed = moved.join(places, ["file", "start"], "left_semi")
        reached = materialize(reached.unionByName(landed).distinct(), "reached-records")
        now = reached.count()
        if now == count:
            break
        count = now
        far = jumps.select("file", F.col("start").alias("next"), F.col("next").alias("far"))
        jumps = materialize(
            jumps.join(far.hint("merge"), ["file", "next"]).select(
                "file", "start", F.col("far").alias("next")
            ),
            "record-jumps",
        )
    return reached


def _joined_payloads(spark: SparkSession, folder: str, records: DataFrame) -> DataFrame:
    """(file, start, size, digest) of records whose payload holds the magic.

    Their files are read again, and the chunks up to each record's end are put together.
    """
    wanted = records.select("file", F.col("start").alias("from"), F.col("next").alias("to"))
    files = wanted.select("file").distinct()
    chunks = _with_starts(
        _chunks(spark, folder).join(files, "file", "left_semi"),
        F.octet_length("text").cast("bigint"),
    )
    # Records do not overlap, so a chunk belongs to the last one that begins before it.
    marked = chunks.join(
        wanted, (chunks["file"] == wanted["file"]) & (F.col("start") == F.col("from")), "left"
    ).select(chunks["file"], "start", "text", "from", "to")
    so_far = Window.partitionBy("file").orderBy("start")
    owned = marked.withColumns(
        {
            "from": F.last("from", ignorenulls=True).over(so_far),
            "to": F.last("to", ignorenulls=True).over(so_far),
        }
    ).filter(F.col("start") < F.col("to"))
    whole = owned.groupBy("file", "from").agg(
        F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts")
    )
    text = whole.select(
        "file",
        F.col("from").alias("start"),
        F.array_join(F.col("parts")["text"], MAGIC).alias("text"),
    ).withColumn("head", F.substring_index("text", END, 1))
    rest = F.substr("text", F.char_length("head") + len(END) + 1)
    block = F.substr(rest, F.lit(1), F.char_length(rest) - len(END))
    columns = _payload_columns(F.col("block"))
    return text.withColumn("block", block).select(
        "file",
        "start",
        columns["size"].alias("joined_size"),
        columns["digest"].alias("joined_digest"),
    )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records.

    A record whose payload does not have the digest it names is an error.
    """
    candidates = materialize(_candidates(spark, folder), "record-candidates")
    reached = _reachable(candidates)
    records = materialize(
        candidates.join(reached.hint("merge"), ["file", "start"], "left_semi"), "reached-records"
    )
    split_up = materialize(records.filter(~F.col("alone")), "records-with-magic")
    joined = _joined_payloads(spark, folder, split_up)
    records = records.join(joined, ["file", "start"], "left")
    size = F.coalesce("joined_size", "size")
    revisit = F.col("kind") == "revisit"
    intact = F.when(revisit, size == 0).otherwise(
        F.coalesce("joined_digest", "digest") == F.col("named")
    )
    digest = F.when(intact, F.col("named")).otherwise(
        F.raise_error(F.concat(F.lit("broken record in "), F.col("file")))
    )
    return records.select(
        "page_id",
        F.when(revisit, F.col("http_length")).otherwise(size).alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/lanewise/{application}/warc-{uuid.uuid4().hex}"
