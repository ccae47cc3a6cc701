"""WARC archives: writing captures as linked records, and assembling captures from the records again.

A capture is written as three records: the response (or a revisit, which has no payload but names the response
with the same one), the request, and metadata with the row's key. The last two name the first in
``WARC-Concurrent-To``. Reading parses records wherever they lie and joins the three by these identifiers, so it does not
depend on their order or on their being in one file.

Everything is done by DataFrame functions. Spark's text sink ends each value with the two empty lines that end a
record, and its text source splits at a line of the record's head, ``WARC-Warcinfo-ID`` with a random
identifier of the archive, which no payload written can contain. In archives without one, it splits at the
version line; a payload that holds such a line fails the job, as its record's length is wrong then.
Files are compressed as a whole, and each is read by one task as a stream; what a task holds is one record.

Nulls and ties: a null payload is an empty one; a null key gives metadata without a key; a null URL gives records without
``WARC-Target-URI``. Among equal payloads the smallest key is the response, null keys come last, and of rows that
repeat a key one is the response, the others revisit it. Line ends in a URL are percent-encoded. An empty table gives an
empty archive, and that no captures. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stakescore import staging

#: Fixed values of the format.
VERSION = "WARC/1.1"
LINE, END = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAIN, SIDE = ("response", "revisit"), ("request", "metadata")
#: Bytes from which equal payloads are stored once.
SMALLEST = 100


def _lines(*lines: Column) -> Column:
    """The lines that are not null, each with its end."""
    return F.concat_ws("", *[F.concat(x, F.lit(LINE)) for x in lines])


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _urn(identifier: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), identifier, F.lit(">"))


def _record(archive: str, kind: Column, identifier: Column, block: Column, content: str, *fields: Column) -> Column:
    """A whole record but for its end."""
    return F.concat(
        _lines(
            F.lit(VERSION), F.lit(f"WARC-Warcinfo-ID: <urn:uuid:{archive}>"), _field("WARC-Type", kind),
            _field("WARC-Record-ID", _urn(identifier)), *fields,
            F.lit(f"Content-Type: {content}"), _field("Content-Length", F.octet_length(block).cast("string")),
        ),
        F.lit(LINE), block,
    )


def write(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    smallest: int = SMALLEST, compression: str = "gzip",
) -> None:
    """Write all rows as captures to the folder ``path``.

    The rows are staged once with their identifiers and digests. Which payloads repeat is found from the digests alone,
    with partial sums before the shuffle; the table of those that do (digest and first record) is joined
    to the rows, broadcast only if Spark finds its files small enough, else with heavy digests split by Spark's skew join.
    """
    content = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = staging.written(
        pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), content.alias("payload")).select(
            "*", F.expr("uuid()").alias("id"), F.expr("uuid()").alias("request_id"), F.expr("uuid()").alias("metadata_id"),
            F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"),
        ), "captures")
    repeated = staging.written(
        rows.filter(F.col("size") >= smallest).groupBy("digest").agg(
            F.min(F.struct(F.col("key").isNull(), "key", "id")).alias("first"), F.count("*").alias("n")
        ).filter("n > 1").select("digest", F.col("first.id").alias("first_id")), "repeated")
    archive = str(uuid.uuid4())
    revisits = F.coalesce(F.col("first_id") != F.col("id"), F.lit(False))
    target = _field("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")))
    date = _field("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    concurrent = _field("WARC-Concurrent-To", _urn(F.col("id")))
    head = F.concat(_lines(
        F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _field("Content-Length", F.col("size").cast("string")),
    ), F.lit(LINE))
    main = _record(
        archive, F.when(revisits, "revisit").otherwise("response"), F.col("id"),
        F.concat(head, F.when(revisits, F.lit("")).otherwise(F.col("payload").cast("string"))),
        "application/http; msgtype=response", date, target, _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisits, _field("WARC-Refers-To", _urn(F.col("first_id")))), F.when(revisits, F.lit(f"WARC-Profile: {PROFILE}")),
    )
    host = F.coalesce(F.parse_url(F.when(F.col("url").rlike(r"^https?://[\w.-]+[/?#]?[\w./?&=%+~#-]*$"), F.col("url")), F.lit("HOST")), F.lit("unknown"))
    request = _record(
        archive, F.lit("request"), F.col("request_id"), F.concat(F.lit("GET / HTTP/1.1\r\nHost: "), host, F.lit(END)),
        "application/http; msgtype=request", date, target, concurrent,
    )
    metadata = _record(
        archive, F.lit("metadata"), F.col("metadata_id"), _lines(_field("key", F.col("key").cast("string"))),
        "application/warc-fields", date, target, concurrent,
    )
    rows.join(repeated, "digest", "left").select(F.concat_ws(END, main, request, metadata)).write.text(
        path, compression=compression, lineSep=END)
    staging.discard(rows)
    staging.discard(repeated)


def _archive(spark: SparkSession, path: str) -> str:
    """The line that names the archive, if its second line is one."""
    first = spark.read.text(path, lineSep=LINE).limit(2).collect()
    return next((r[0] + LINE for r in first if r[0].startswith("WARC-Warcinfo-ID: ")), "")


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_id, record_type, target_uri, date, concurrent_to (array), refers_to, payload_digest (as
    stated), content_type, ``block`` and, of HTTP responses, ``payload`` (both binary).

    A record whose block has not the length stated fails the job, so no archive is read in part.
    """
    # The first line of a record; neither line can overlap itself, so the source finds it wherever files are cut.
    line = _archive(spark, path) or VERSION + LINE
    raw = spark.read.text(path, lineSep=line).filter(~F.col("value").isin("", VERSION + LINE)).select(
        F.substring_index("value", END, 1).alias("fields"), F.col("value").cast("binary").alias("all"))

    def field(name: str) -> Column:
        found = F.regexp_extract("fields", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
        return F.when(found != "", found)

    def bare(value: Column) -> Column:
        return F.regexp_replace(value, "^<(urn:uuid:)?|>$", "")

    size = field("Content-Length").cast("bigint")
    begin = F.octet_length("fields") + len(END)
    block = F.substr("all", (begin + 1).cast("int"), size.cast("int"))
    whole = (F.octet_length("all") - begin - size).isin(0, len(END), len(END + VERSION + LINE))
    kind = F.lower(field("WARC-Type"))
    concurrent = F.transform(F.regexp_extract_all("fields", F.lit(r"(?im)^WARC-Concurrent-To:[ \t]*([^\r\n]*)"), F.lit(1)), bare)
    checked = F.when(F.coalesce(whole, F.lit(False)), block).otherwise(
        F.raise_error(F.concat(F.lit("a record of another length than stated: "), F.col("fields"))).cast("binary"))
    out = raw.select(
        bare(field("WARC-Record-ID")).alias("record_id"), kind.alias("record_type"), field("WARC-Target-URI").alias("target_uri"),
        field("WARC-Date").alias("date"), concurrent.alias("concurrent_to"), bare(field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^[^:]*:", "").alias("payload_digest"),
        field("Content-Type").alias("content_type"), checked.alias("block"),
    )
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), END, 1)) + len(END) + 1
    body = F.substr("block", http.cast("int"))
    return out.withColumn("payload", F.when((F.col("record_type") == "response") & F.col("content_type").startswith("application/http"), body))


def captures(found: DataFrame, payload: bool = True) -> DataFrame:
    """One nested row per response or revisit among :func:`records`: record_id, record_type, target_uri, date, key,
    ``response`` (payload_bytes, payload_digest, both of the bytes read; intact: as stated), ``request`` and ``metadata``
    (record_id, block), ``refers`` (record_id, key, payload_bytes, payload_digest of the response that a revisit names) and, if
    asked for, the payload.

    A request or metadata record may name the response, or be named by it. Of several of a kind that of the smallest
    identifier is taken, so that no group is collected; a missing one, and a response that is not in the
    archive, is null. Records are staged without payloads; payloads are shuffled only if asked for.
    """
    narrow = staging.written(found.select(
        "record_id", "record_type", "target_uri", "date", "concurrent_to", "refers_to", "payload_digest",
        F.when(F.col("record_type").isin(*SIDE), F.col("block")).alias("block"),
        F.octet_length("payload").cast("bigint").alias("bytes"), F.sha2("payload", 256).alias("digest"),
    ), "records")
    mains, sides = (narrow.filter(F.col("record_type").isin(*kinds)) for kinds in (MAIN, SIDE))
    one = sides.select("record_id", "record_type", "block", F.explode("concurrent_to").alias("main_id"))
    named = mains.select(F.col("record_id").alias("main_id"), F.explode("concurrent_to").alias("record_id"))
    links = one.unionByName(named.join(sides.select("record_id", "record_type", "block"), "record_id"))
    parts = links.groupBy("main_id").agg(*[
        F.min(F.when(F.col("record_type") == kind, F.struct("record_id", "block"))).alias(kind) for kind in SIDE
    ])
    read = F.struct(
        F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        (F.col("digest") == F.col("payload_digest")).alias("intact"),
    )
    key = F.regexp_extract(F.col("metadata.block").cast("string"), r"(?m)^key: ([^\r\n]*)", 1)
    joined = staging.written(
        mains.join(parts, F.col("record_id") == F.col("main_id"), "left").select(
            "record_id", "record_type", "target_uri", "date", F.when(key != "", key).alias("key"),
            F.when(F.col("record_type") == "response", read).alias("response"), "request", "metadata", "refers_to",
        ), "captures")
    responses = joined.filter("record_type = 'response'")
    target = responses.select(F.col("record_id").alias("refers_to"), F.struct(
        "record_id", "key", "response.payload_bytes", "response.payload_digest").alias("refers"))
    # Only revisits are joined, so rows that refer to nothing do not meet in one task.
    revisits = joined.filter("record_type <> 'response'").join(target, "refers_to", "left").drop("refers_to")
    whole = responses.drop("refers_to").withColumn("refers", F.lit(None).cast(revisits.schema["refers"].dataType)).unionByName(revisits)
    return whole.join(found.select("record_id", "payload"), "record_id", "left") if payload else whole


def digests(assembled: DataFrame) -> DataFrame:
    """Per capture: key, payload_bytes, payload_digest (a revisit's: of the payload it refers to), record_type, refers_to (key)."""
    def of(name: str) -> Column:
        return F.coalesce(F.col(f"response.{name}"), F.col(f"refers.{name}")).alias(name)

    return assembled.select("key", of("payload_bytes"), of("payload_digest"), "record_type", F.col("refers.key").alias("refers_to"))
