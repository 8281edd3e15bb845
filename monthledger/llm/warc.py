"""WARC archives with revisit resolution.

Headers (page, digest, length) are shuffled by payload digest; the smallest
page of each digest becomes the response, the others revisit records that
refer to it. Spark's text writer writes the records (the record separator is
its line separator), so lost tasks are written again under its commit
protocol; files are gzip-compressed whole. Reading takes the archives as
binary files, walks the records by Content-Length, and joins every revisit to
the response it refers to.

Cases: null html is an empty payload; payloads under ``least`` bytes are
always responses; several rows with one page_id and payload: the first of them
is the response, the rest revisit it; null page_id or url are kept (null id
sorts last); an empty table gives no records; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthledger.llm.common import materialize, new_path, passing, ship, table

ship(__name__)

LEAST = 100
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, record_type string, page_id long, url string, refers_to string, payload_bytes long, payload_digest string"


def resolve(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Adds html, digest, bytes, nth (of equal rows) and original page."""
    html = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", "url", html.alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html").cast("long"))
    # headers alone are shuffled by digest: of every repeated payload the smallest page and its number of rows
    heads = p.where(F.col("bytes") >= least).groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("c"))
    low = F.min(F.struct(F.col("page_id").isNull(), "page_id", "c")).alias("s")
    heads = heads.groupBy("digest").agg(low, F.sum("c").alias("n")).where("n > 1")
    heads = materialize(heads.select("digest", F.col("s.page_id").alias("original"), "n", F.col("s.c").alias("m")), "heads")
    twice = materialize(heads.where("m > 1"), "twice")
    own = F.col("page_id").eqNullSafe(F.col("original"))
    first = p.join(heads, "digest", "left").where(F.col("m").isNull() | (F.col("m") == 1) | ~own).withColumn("nth", F.lit(1))
    same = Window.partitionBy("digest", "page_id").orderBy(F.col("url").asc_nulls_last())
    again = p.join(twice, "digest").where(own).withColumn("nth", F.row_number().over(same))
    p = first.unionByName(again)
    revisit = F.col("n").isNotNull() & ~(own & (F.col("nth") == 1))
    return p.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))


def record(date: str):
    uid = lambda page: F.concat(F.lit("urn:sha1:"), F.sha1(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("-")), F.col("digest"))))
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("html")))
    own = F.concat(uid(F.col("page_id")), F.when(is_revisit, F.concat(F.lit("-r"), F.col("nth").cast("string"))).otherwise(""))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))
    safe = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7f]", "%20")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<"), own, F.lit(">"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", safe), F.lit("")), F.coalesce(line("X-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(is_revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<"), uid(F.col("original")), F.lit(">"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block,
    )


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", per_file: int = 4000) -> None:
    out = resolve(pages).select(record(date).alias("value"))
    out.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def records(stream):
    """(headers, block) of each record; the block's length is its header's."""
    while (line := stream.readline()) != b"":
        if line.strip() != b"WARC/1.1":
            continue
        head = {}
        while (line := stream.readline()).strip():
            k, _, v = line.partition(b":")
            head[k.decode().lower()] = v.strip().decode()
        yield head, stream.read(int(head["content-length"]))


def _parse(batches):
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for head, block in records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))):
                body = block.partition(b"\r\n\r\n")[2]
                response = head["warc-type"] == "response"
                page = head.get("x-page-id")
                rows.append((
                    head["warc-record-id"], head["warc-type"], int(page) if page else None, head.get("warc-target-uri"), head.get("warc-refers-to"),
                    len(body) if response else None, hashlib.sha256(body).hexdigest() if response else None,
                ))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")])
            yield out.astype({"page_id": "Int64", "payload_bytes": "Int64"})


def read(spark, path: str) -> DataFrame:
    """One row per record; revisits carry the payload of what they refer to."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    r = files.mapInPandas(_parse, RECORD)
    full = r.where("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")
    )
    revisits = r.where("record_type = 'revisit'").join(full.dropDuplicates(["_id"]), F.col("refers_to") == F.col("_id"), "left")
    again = revisits.select("page_id", "url", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"), "record_type", F.col("_page").alias("refers_to"))
    own = r.where("record_type = 'response'").select("page_id", "url", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(again)


def op2(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    passing(spark, path)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
with p as (select page_id, sha256(coalesce(html,'')) as d, octet_length(encode(coalesce(html,'')))::bigint as n from pages),
r as (select *, min(page_id) over (partition by d) as o, row_number() over (partition by d order by page_id) as k from p)
select page_id, n as payload_bytes, d as payload_digest, case when n >= 100 and k > 1 then 'revisit' else 'response' end as record_type,
 case when n >= 100 and k > 1 then o end as refers_to from r
"""
