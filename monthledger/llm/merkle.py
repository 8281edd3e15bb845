"""Document fingerprints: Merkle tree over paragraphs and sections.

A paragraph (line) is a node over its sentences, a section (blank-line block) a
node over its paragraphs, the root a node over the sections. Equal roots mean
equal texts; ``differing`` walks down only branches whose hashes differ. The
fingerprint is the root, then the leaves in order; the likeness of two
fingerprints is the share of leaves (by length) that both hold.

The next document in descending doc_id comes from a split into ranges of
doc_id: rows stream in order within a range, and each range gets one carried
row, the last of the range below it. No range is held in memory. Spark's range
partitioner makes the ranges from the ids alone; their number comes from the
session (``RANGES`` times its shuffle partitions), never from the rows, and
only their largest ids, one number each, go into the plan.

Cases: null text is empty (one leaf, the empty one); likeness of equal
fingerprints is 1; null doc_id sorts last in descending order; repeated doc_ids
sort by text (rows of one id share a range); a single document is its own next;
empty table, empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthledger.llm.common import ship, table

ship(__name__)

LEAF = re.compile(r"[^\n]{1,400}?(?:[.!?](?=\s)|\n|$)\s*|[^\n]{1,400}(?<=\s)|[^\n]{1,400}|\n", re.S)
SECTION = re.compile(r"\n[^\S\n]*\n\s*")
#: Ranges of doc_id for each shuffle partition of the session.
RANGES = 4

RESULT = (
    "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    "differing array<struct<section:int,paragraph:int>>"
)


def h(data: str) -> str:
    return hashlib.blake2b(data.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def tree(text: str) -> tuple[str, list]:
    """(root, [(hash, [(hash, [(hash, length) leaves]) paragraphs]) sections])."""
    sections = []
    at = 0
    cuts = [m.end() for m in SECTION.finditer(text)]
    for end in [*cuts, len(text)]:
        if end > at or not sections and end == len(text):
            paragraphs = []
            for p in text[at:end].splitlines(keepends=True) or [""]:
                leaves = [(h(x), len(x)) for x in LEAF.findall(p)] or [(h(p), len(p))]
                paragraphs.append((h("p" + "".join(x for x, _ in leaves)), leaves))
            sections.append((h("s" + "".join(x for x, _ in paragraphs)), paragraphs))
            at = end
    root = hashlib.sha256(("d" + "".join(x for x, _ in sections)).encode()).hexdigest()
    return root, sections


def printed(root: str, sections: list) -> str:
    return root + ":" + ",".join(f"{x}{n:x}" for _, ps in sections for _, leaves in ps for x, n in leaves)


def fingerprint(text: str) -> str:
    return printed(*tree(text))


def likeness(a: str, b: str) -> float:
    if a.partition(":")[0] == b.partition(":")[0]:
        return 1.0
    x, y = (Counter(f.partition(":")[2].split(",")) for f in (a, b))
    size = lambda c: sum(int(k[16:], 16) * n for k, n in c.items())
    total = size(x) + size(y)
    return 2 * size(x & y) / total if total else 1.0


def branches(a: tuple, b: tuple) -> list[tuple[int, int]]:
    """(section, paragraph) of tree ``b`` whose branch has no equal in ``a``."""
    (ra, sa), (rb, sb) = a, b
    if ra == rb:
        return []
    known, paragraphs = {s for s, _ in sa}, {p for _, ps in sa for p, _ in ps}
    return [(i, j) for i, (s, ps) in enumerate(sb) if s not in known for j, (p, _) in enumerate(ps) if p not in paragraphs]


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``b`` whose branch has no equal in ``a``."""
    return branches(tree(a), tree(b))


def edited(text: str, nxt: str) -> str:
    k = len(text) // 2
    return text[: len(text) - k] + nxt[:k]


def range_tops(ids: DataFrame, ranges: int) -> list[int]:
    """The largest id of each range, ascending: at most ``ranges`` numbers."""
    dealt = ids.where("doc_id is not null").repartitionByRange(ranges, "doc_id").withColumn("part", F.spark_partition_id())
    return sorted(r.top for r in dealt.groupBy("part").agg(F.max("doc_id").alias("top")).collect())


def range_of(value: Column, tops: Column, n: int) -> Column:
    """How many of the ``n`` sorted ``tops`` lie below ``value``, by halving steps (null: 0)."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))]) if n else F.array().cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(tops, at + step - 1) < value, at + step).otherwise(at))


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows keyed by range, each range led by the last row of the one below
    (the first range by the last row of all)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = range_tops(d.select("doc_id"), RANGES * parts)
    n = len(found)
    tops = F.split(F.lit(",".join(map(str, found))), ",").cast("array<bigint>")  # folded to one constant
    d = d.withColumn("part", range_of(F.col("doc_id"), tops, n))
    last = F.col("doc_id") == F.get(tops, F.col("part")) if n else F.lit(True)  # without any id all rows are one range
    lead = d.where(last).groupBy("part", "doc_id").agg(F.max("text").alias("text"))
    lead = lead.select("doc_id", "text", ((F.col("part") + 1) % max(1, n)).alias("part"), F.lit(0).alias("own"))
    return lead.unionByName(d.withColumn("own", F.lit(1))), parts


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_text, both fingerprints, their likeness to each
    other and to the next document's, and the paragraphs where the edit is seen."""
    rows, parts = with_next(docs)
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "own", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        part, prev, prev_print = None, None, None
        for b in batches:
            out = []
            for doc_id, text, p, own in zip(b["doc_id"].astype("Int64"), b["text"], b["part"], b["own"]):
                if p != part or not own:
                    part, prev, prev_print = p, text, None
                if own:
                    if prev_print is None:
                        prev_print = fingerprint(prev)
                    e = edited(text, prev)
                    own_tree, new_tree = tree(text), tree(e)
                    mine, ep = printed(*own_tree), printed(*new_tree)
                    where = [{"section": i, "paragraph": j} for i, j in branches(own_tree, new_tree)]
                    out.append((doc_id, len(text), e, mine, ep, likeness(mine, ep), likeness(mine, prev_print), where))
                    prev, prev_print = text, mine
                if len(out) >= 200:
                    yield frame(out)
                    out = []
            if out:
                yield frame(out)

    def frame(out):
        names = ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "differing"]
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return rows.mapInPandas(run, RESULT)


def op10(spark, sf_dir: str) -> DataFrame:
    f = fingerprints(table(spark, sf_dir, "documents"))
    where = F.transform("differing", lambda x: F.concat_ws(".", x["section"].cast("string"), x["paragraph"].cast("string")))
    return f.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.array_join(where, ",").alias("differing"),
    )
