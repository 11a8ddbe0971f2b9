"""WARC archives: writing, and reading by boundary-chain verification.

``write`` makes one record per page with native expressions: pages of equal payloads of
some size are written in full once and as revisits otherwise. Lines of the text writer
carry the raw bytes, so the files are plain WARC.

``read`` splits the files at the magic line, which Spark's line reader finds in any split
of a file. Each piece is a candidate record: its offset comes from the sizes of the pieces
before it, the offset of its successor from its headers. A payload may hold the magic
itself, so a candidate counts only if the chain of successors from the start of the file
reaches it. The chain is followed by pointer jumping: in round k every candidate knows
the candidate 2**k records on, and the reachable set doubles. What is not reachable is
payload of the record before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import new_dir, written

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST_BYTES = 100
DATE = "2024-01-01T00:00:00Z"


def _originals(rows: DataFrame, least_bytes: int) -> DataFrame:
    """digest -> smallest id, of payloads that more than one id has."""
    return (
        rows.filter(F.col("bytes") >= least_bytes).groupBy(F.col("digest").alias("equal"))
        .agg(F.min("id").alias("original"), F.max("id").alias("other"),
             F.count("*").alias("n"), F.count("id").alias("named"))
        .filter("original != other OR (named > 0 AND named < n)")
        .select("equal", "original")
    )


def write(pages: DataFrame, path: str, id_column: str = "page_id", payload: str = "html",
          url: str = "url", least_bytes: int = LEAST_BYTES) -> None:
    """One WARC file per task into ``path``.

    Of equal payloads of at least ``least_bytes`` the smallest id is a response and others
    revisit it; null ids come last; rows that repeat an id and its payload are one capture
    and all written as what that is. Null payloads are empty, line ends in a url are
    spaces. No pages give a folder without records.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
        body.alias("body"), F.octet_length(body).cast("long").alias("bytes"),
        F.sha2(body, 256).alias("digest"),
    )
    equal = written(_originals(rows.select("id", "bytes", "digest"), least_bytes), "warc-originals")
    other = F.col("equal").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    whole = rows.join(broadcast_if_small(equal), F.col("digest") == F.col("equal"), "left")
    whole.withColumn("revisit", F.coalesce(other, F.lit(False))).select(
        _record().alias("value")
    ).write.text(path, lineSep="\n")


def _record() -> Column:
    """A row's record without its last byte, which is the writer's line end."""
    named = [
        ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", _page(F.coalesce(F.col("id").cast("string"), F.lit("")))),
        ("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("X-Payload-Length", F.col("bytes").cast("string")),
        ("WARC-Refers-To", F.when(F.col("revisit"), _page(F.col("original").cast("string")))),
        ("Content-Length", F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))
         .cast("string")),
    ]
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
             for name, value in named]
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("body").cast("string"))
    return F.concat(F.lit(MAGIC), *lines, F.lit("\r\n"), body, F.lit(END[:-1]))


def _page(value: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), value, F.lit(">"))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magic lines: file, block (start of the split), place (rising
    within a split), and the value."""
    lines = spark.read.schema("value string").option("lineSep", MAGIC).text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value",
    )


def with_offsets(rows: DataFrame) -> DataFrame:
    """``rows`` (file, block, place, bytes, ...) with the offset of the magic line before
    each piece, from prefix sums over blocks and within them; negative for what comes
    before the first magic line."""
    step = F.col("bytes") + len(MAGIC)
    blocks = rows.groupBy("file", "block").agg(F.sum(step).alias("sum"))
    in_file = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("before", F.sum("sum").over(in_file) - F.col("sum")).drop("sum")
    in_block = Window.partitionBy("file", "block").orderBy("place")
    upto = F.sum(step).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("upto", upto).join(blocks, ["file", "block"]).withColumn(
        "offset", F.col("before") + F.col("upto") - step - len(MAGIC)
    ).drop("block", "place", "before", "upto")


def _header(name: str) -> Column:
    return F.regexp_extract("header", rf"(?i)(?:^|\n){name}: ?([^\r]*)", 1)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece, without its bytes: file, offset, successor and headers; digest
    and length of its payload if the piece holds all of it."""
    header = F.substring_index("value", END, 1)
    rows = pieces(spark, path).withColumn("header", header).select(
        "file", "block", "place", F.octet_length("value").cast("long").alias("bytes"), "value",
        "header", (F.octet_length("header") + len(END)).cast("long").alias("head"),
    ).withColumn("content", _header("Content-Length").try_cast("long"))
    whole = F.col("head") + F.col("content") + len(END) == F.col("bytes")
    body = F.substring(F.col("value").cast("binary"), F.col("head") + 1, F.col("content"))
    rows = rows.select(
        "file", "block", "place", "bytes", "head", "content", whole.alias("whole"),
        *[_header(name).alias(column) for column, name in HEADERS.items()],
        F.when(whole, F.sha2(body, 256)).alias("computed"),
    )
    rows = written(rows, "warc-pieces")
    successor = F.col("offset") + len(MAGIC) + F.col("head") + F.col("content") + len(END)
    found = with_offsets(rows).filter("offset >= 0").withColumn("successor", successor)
    return written(found, "warc-candidates")


HEADERS = {
    "type": "WARC-Type", "record": "WARC-Record-ID", "url": "WARC-Target-URI",
    "declared": "WARC-Payload-Digest", "length": "X-Payload-Length", "refers": "WARC-Refers-To",
}


def reachable(found: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from offset 0 of their file
    reaches. ``found`` has file, offset and successor; rounds grow with the logarithm of
    the longest chain."""
    links = written(
        found.select("file", "offset", F.col("successor").alias("to"),
                     (F.col("offset") == 0).alias("reached")), "warc-links")
    before = -1
    while True:
        now = links.filter("reached").count()
        if now == before:
            return links.filter("reached").select("file", "offset")
        before = now
        marks = links.filter("reached AND to IS NOT NULL").select(
            "file", F.col("to").alias("offset"), F.lit(True).alias("marked")).distinct()
        onward = links.filter("to IS NOT NULL").select(
            "file", F.col("offset").alias("to"), F.col("to").alias("further"))
        links = written(
            links.join(onward, ["file", "to"], "left").join(marks, ["file", "offset"], "left")
            .select("file", "offset", F.col("further").alias("to"),
                    (F.col("reached") | F.coalesce("marked", F.lit(False))).alias("reached")),
            "warc-links")


def _spanning(spark: SparkSession, path: str, records: DataFrame, found: DataFrame) -> DataFrame:
    """(file, offset, joined) of records whose payload holds magic lines: the digest of
    the payload put together from its pieces. Only their files are read again."""
    broken = records.filter(~F.col("whole")).select("file", "offset", "head", "content")
    files = broken.select("file").distinct()
    starts = records.select("file", "offset", F.col("offset").alias("start"))
    in_file = Window.partitionBy("file").orderBy("offset")
    owners = (
        found.select("file", "offset").join(files, "file")
        .join(starts, ["file", "offset"], "left")
        .select("file", "offset", F.last("start", True).over(in_file).alias("owner"))
    )
    owners = owners.join(
        broken.select("file", F.col("offset").alias("owner"), "head", "content"), ["file", "owner"])
    bytes_ = F.octet_length("value").cast("long")
    again = with_offsets(pieces(spark, path).join(files, "file").withColumn("bytes", bytes_))
    parts = again.join(owners, ["file", "offset"]).groupBy("file", "owner", "head", "content").agg(
        F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC).cast("binary")
    body = F.substring(text, F.col("head") + 1, F.col("content"))
    return parts.select("file", F.col("owner").alias("offset"), F.sha2(body, 256).alias("joined"))


def read(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The records of all WARC files of ``path``: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to and digest_ok (a response's payload has the
    digest that its header names). A record without content length ends its file."""
    found = candidates(spark, path)
    records = written(found.join(reachable(found), ["file", "offset"]).filter(
        F.col("content").isNotNull()), "warc-records")
    if records.filter(~F.col("whole")).isEmpty():
        records = records.withColumn("joined", F.lit(None).cast("string"))
    else:
        records = records.join(
            written(_spanning(spark, path, records, found), "warc-joined"), ["file", "offset"], "left")
    computed = F.coalesce("computed", "joined")
    declared = F.substring_index("declared", ":", -1)
    revisit = F.col("type") == "revisit"

    def page(name: str) -> Column:
        return F.regexp_extract(name, "^<urn:x-page:(.*)>$", 1).try_cast(id_type)

    return records.select(
        page("record").alias("page_id"), "url",
        F.when(revisit, F.col("length").try_cast("long")).otherwise(F.col("content"))
        .alias("payload_bytes"),
        F.when(revisit, declared).otherwise(computed).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, page("refers")).alias("refers_to"),
        (revisit | (computed == declared)).alias("digest_ok"),
    )


def archive_and_read(pages: DataFrame, id_column: str = "page_id", payload: str = "html",
                     url: str = "url") -> DataFrame:
    """Write ``pages`` to new archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_dir(spark, "warc")
    write(pages, path, id_column, payload, url)
    return read(spark, path, pages.schema[id_column].dataType.simpleString())
