"""Secret scans over an incremental blob ledger. Native DataFrame code.

Every text is content-addressed (SHA-256). The ledger is a Parquet table of
(rule_version, blob, spans) in a shared folder, the version made from a digest
of the rules: a scan takes the distinct blobs, drops those the ledger has for
this rule version, scans each of the
rest once, appends them, and joins the findings back to every document.

Cases: null text is the empty blob; repeated rows each get their row; ties of
the start sort by kind as listed; an empty table gives an empty result; long
texts are scanned whole; extra columns are kept by ``redact`` and ignored by
``scan``. Hot blobs meet only as (id, digest) rows, which adaptive execution
splits; a blob's text is read through one of its documents. Once a ledger is
there, texts are narrowed to unseen blobs before anything of them is shuffled:
while those are few Spark broadcasts their digests, and only their texts move.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthledger.llm.common import file_system, materialize, new_path, packed, passing, quoted, table

#: Fixed values: (kind, pattern, group whose length counts, least length).
BASE_RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),
)
MORE_RULES = (
    ("pem", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 20),
    ("github", r"(gh[pousr]_[A-Za-z0-9]{36,})", 1, 40),
    ("slack", r"(xox[abprs]-[A-Za-z0-9-]{10,})", 1, 15),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 30),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "rules-1"
#: Matches whose spans are put together at a time.
RUN = 256
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"


def spans_of(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans (code points, stop exclusive) of one kind: the texts between the
    matches and the matches themselves give every position."""
    p = F.lit(pattern)
    full, counted = F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(group))
    parts = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(full)), lambda x: F.length(x))
    rows = F.arrays_zip(parts.alias("gap"), full.alias("hit"), counted.alias("value"))
    step_of = lambda row: row["gap"] + F.length(row["hit"])

    def step(acc, row):
        begin = acc["at"] + row["gap"]
        stop = begin + F.length(row["hit"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"))
        kept = F.when(F.length(row["value"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(stop.alias("at"), kept.cast(SPAN).alias("out"))

    def spans(cut):
        """Appending copies what is there: so lists of ``RUN`` matches, then
        the runs' starts, then the spans of each run from its start."""
        sums = F.transform(cut, lambda run: F.aggregate(run, F.lit(0), lambda at, row: at + step_of(row)))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(
            sums, zero, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"]
        )
        runs = F.arrays_zip(cut.alias("run"), starts.alias("at"))
        begin = lambda x: F.struct(x["at"].alias("at"), F.array().cast(SPAN).alias("out"))
        return F.flatten(F.transform(runs, lambda x: F.aggregate(x["run"], begin(x), step, lambda acc: acc["out"])))

    def cut(all_rows):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_rows) - 1) / RUN).cast("int")), lambda i: F.slice(all_rows, i * RUN + 1, F.lit(RUN)))

    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)  # noqa: E731  a value used more than once
    found = once(rows, lambda r: once(cut(r), spans))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def scan_text(text: Column, rules=RULES) -> Column:
    return F.array_sort(F.concat(*[spans_of(text, i, *rule) for i, rule in enumerate(rules)]))


def version_of(rules, version: str = RULE_VERSION) -> str:
    """The ledger key: the version of the scan's code and the rules themselves."""
    return f"{version}-{hashlib.sha256(repr([tuple(r) for r in rules]).encode()).hexdigest()[:16]}"


def scan(docs: DataFrame, ledger: str | None = None, rules=RULES, version: str = RULE_VERSION) -> DataFrame:
    """(doc_id, blob, spans) of every row; the ledger at ``ledger`` grows."""
    spark, version = docs.sparkSession, version_of(rules, version)
    own = ledger is None
    ledger = ledger or new_path(spark, "ledger")
    rows = materialize(docs.select("doc_id", digest_of(docs).alias("blob")), "blobs")
    fresh = rows.groupBy("blob").agg(F.min(who(rows)).alias("who"))
    schema = f"blob string, spans {SPAN}, rule_version string"
    fs, path = file_system(spark, ledger)
    there = fs.exists(path)
    if there:
        known = spark.read.schema(schema).parquet(ledger).where(F.col("rule_version") == version)
        fresh = materialize(fresh.join(known.select("blob"), "blob", "left_anti"), "unseen")
    found = unseen_texts(docs, fresh, there).select("blob", scan_text(F.col("text"), rules).alias("spans"), F.lit(version).alias("rule_version"))
    found.write.mode("append").partitionBy("rule_version").parquet(ledger)
    if own:
        passing(spark, ledger)
    known = spark.read.schema(schema).parquet(ledger).where(F.col("rule_version") == version)
    hits = known.where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
    out = rows.join(hits, "blob", "left")
    return out.select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def who(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("string"), F.lit(""))


def digest_of(docs: DataFrame) -> Column:
    return F.sha2(F.coalesce(docs["text"], F.lit("")), 256)


def unseen_texts(docs: DataFrame, fresh: DataFrame, some_seen: bool) -> DataFrame:
    """(blob, who, text), one row for each row of ``fresh`` (blob, who)."""
    texts = docs.select(digest_of(docs).alias("blob"), who(docs).alias("who"), F.coalesce("text", F.lit("")).alias("text"))
    if some_seen:
        return texts.join(fresh, ["blob", "who"], "left_semi").dropDuplicates(["blob", "who"])
    # equal rows of one doc_id collapse before the one shuffle of texts
    return texts.dropDuplicates(["blob", "who"]).join(fresh, ["blob", "who"])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op4(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return found.select(
        "doc_id", *[count(r[0]) for r in BASE_RULES], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """Documents with every found span masked; overlapping spans get one mask."""
    found = scan(docs).where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
    d = docs.select(packed(docs).alias("row"), digest_of(docs).alias("own"))
    d = d.join(found, F.col("own") == F.col("blob"), "left")
    text = F.col("row.text")

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate("spans", zero, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    d = d.withColumn("masked", F.when(F.col("spans").isNull(), text).otherwise(masked))
    chars = F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length("masked").cast("long")) if "n_chars" in docs.columns else None
    new = {"text": F.col("masked"), "n_chars": chars}
    return d.select(*[new.get(c, F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns])


def secrets_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)
