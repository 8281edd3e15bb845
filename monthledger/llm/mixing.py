"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Native DataFrame code. Sizes are word counts. Each source gets a target share
of all words by its weight, at most ``max_epochs`` times its own size (the
excess is shared out again by weight). Whole epochs come first; the rest of
the target is a weighted sample without replacement: every document draws the
exponential key -ln(u)/quality, the source is sorted by key, and the prefix
whose running size stays nearest to the remaining budget is taken once more.

The draw u is a hash of doc_id (of the text where that is null) and seed, so
reruns agree. A hot source
is never sorted in one task: keys fall into ``BUCKETS`` ranges, the sums of
(source, bucket) are combined map-side, and only rows inside one (source,
bucket) are sorted together.

Cases: null or empty text has size 0; null source is a source of its own, last
in order; null or missing quality weighs 1; repeated rows are rows of their
own (ties of the key break by doc_id, then by order; the stage deals the copies
of rows that are equal in doc_id, source and size over them by text); an empty
table gives an empty result; extra columns are ignored, in the stage kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthledger.llm.common import WORD, materialize, packed, table, unpacked

BUCKETS = 4096
MAX_EPOCHS = 3
QUALITY = {"good": 2.0, "poor": 0.5}


def source_targets(sizes: DataFrame, cycle: int = 3, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    target = min(max_epochs * size, level * weight) for the one level at which
    the targets add up to all sizes; sources are capped in order of cap/weight.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("w", ((F.row_number().over(order) - 1) % cycle + 1).cast("double"))
    s = s.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), zero)
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), zero)
    s = s.withColumn("level", left / weight)
    free = F.max("level").over(every)  # levels rise while sources are capped and fall after the first that is not
    return s.select("source", "source_size", F.least("cap", free * F.col("w")).alias("target"))


def plan_mix(sized: DataFrame) -> DataFrame:
    """(key, source, size, quality, draw) -> adds source_size, target, copies."""
    e = -F.log(F.col("draw")) / F.coalesce("quality", F.lit(1.0))
    d = sized.withColumn("e", e).withColumn("bucket", F.floor((1 - F.exp(-F.col("e"))) * BUCKETS))
    same = Window.partitionBy("source", "bucket")
    inside = same.orderBy("e", "key").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    targets = source_targets(sized)
    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("bucket_size").over(upto), F.lit(0))).drop("bucket_size")
    t = targets.withColumnRenamed("source", "t_source")
    sums = sums.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    sums = sums.withColumnsRenamed({"source": "s_source", "bucket": "s_bucket"})
    d = d.join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    more = F.col("before") + F.col("inside") + F.col("size") / 2 <= F.col("rest")
    d = d.withColumn("epochs", epochs.cast("long")).withColumn("rest", rest)
    d = d.withColumn("copies", F.col("epochs") + F.when(more & (F.col("rest") > 0), 1).otherwise(0))
    return d.drop("s_source", "s_bucket", "epochs", "rest", "before", "inside", "bucket", "e")


def label_quality(labels: DataFrame) -> DataFrame:
    """(doc_id, quality weight): of several labels the lowest counts."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    w = F.when(good, QUALITY["good"]).otherwise(QUALITY["poor"])
    rows = labels.where("doc_id is not null and quality is not null").select("doc_id", w.alias("quality"))
    return rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mixed(docs: DataFrame, labels: DataFrame | None, seed: str) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row."""
    text = F.coalesce("text", F.lit(""))
    h = F.md5(F.concat_ws("\x1f", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.md5(text)))))
    draw = (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 0.5) / float(16**12)
    d = docs.select("doc_id", "source", size_of(text).alias("size"), draw.alias("draw"))
    if labels is not None:
        d = d.join(label_quality(labels), "doc_id", "left")
    else:
        d = d.withColumn("quality", F.lit(1.0))
    d = materialize(d, "sizes").withColumn("key", F.struct("doc_id", "size"))
    return plan_mix(d).select("doc_id", "source", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, labels: DataFrame | None = None, seed: str = "mix-1") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document."""
    d = mixed(docs, labels, seed).withColumn("taken", F.col("copies") * F.col("size"))
    return d.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op1(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def repeat(docs: DataFrame, labels: DataFrame | None = None, seed: str = "mix-1") -> DataFrame:
    """Every row as often as the mix takes it.

    Rows that agree in doc_id, source and size mostly have the same number of
    copies and meet it in one join. The few such groups whose rows differ (by
    one, in the order of the text) are numbered; no other text is sorted.
    """
    same = ["p_id", "p_source", "p_size"]
    plan = mixed(docs, labels, seed).select(F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size"), "copies")
    plan = plan.groupBy(*same).agg(F.max("copies").alias("most"), F.sum("copies").alias("total"), F.count(F.lit(1)).alias("n"))
    plan = materialize(plan.where("total > 0"), "copies")
    rows = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("source"), size_of(F.col("text")).alias("size"))
    match = F.col("id").eqNullSafe(F.col("p_id")) & F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))
    even = rows.join(plan.where("total = most * n"), match).select("row", F.col("most").alias("copies"))
    uneven = rows.join(materialize(plan.where("total < most * n"), "uneven"), match)
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("row.text"))
    more = F.col("total") - F.col("n") * (F.col("most") - 1)  # so many rows have one copy more than the rest
    uneven = uneven.withColumn("nth", nth).select("row", F.when(F.col("nth") <= more, F.col("most")).otherwise(F.col("most") - 1).alias("copies"))
    out = even.unionByName(uneven).where("copies > 0")
    return unpacked(out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs)


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return repeat(docs, table(spark, sf_dir, "labels"))


SQL = r"""
with d as (
 select doc_id, source, len(regexp_extract_all(coalesce(text,''), '[^\x20\x09-\x0D]+')) as size,
  (('0x' || substr(md5(concat_ws(chr(31),'mix-1',coalesce(doc_id::varchar,'-' || md5(coalesce(text,''))))),1,12))::bigint::double + 0.5)/281474976710656.0 as draw
 from documents),
q as (select doc_id, min(case when quality=1 and coalesce(toxic,0)=0 then 2.0 else 0.5 end) as quality from labels
 where doc_id is not null and quality is not null group by doc_id),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, ((row_number() over (order by source asc nulls last) - 1) % 3 + 1)::double as w, source_size*3.0::double as cap from s),
l as (select *, ((sum(source_size) over ())::double - coalesce(sum(cap) over before, 0))
   / (sum(w) over () - coalesce(sum(w) over before, 0)) as level from w
 window before as (order by cap/w, source asc nulls last rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, least(cap, w * (select max(level) from l)) as target from l),
r as (select d.*, t.source_size, t.target, floor(case when t.source_size > 0 then t.target/t.source_size else 0 end)::bigint as epochs,
  coalesce(sum(size) over (partition by d.source order by -ln(draw)/coalesce(q.quality,1.0), d.doc_id, d.size
   rows between unbounded preceding and 1 preceding), 0) as before
 from d left join q on q.doc_id = d.doc_id join t on t.source is not distinct from d.source),
c as (select *, epochs + case when before + size/2.0 <= target - epochs*source_size and target - epochs*source_size > 0 then 1 else 0 end as copies from r)
select doc_id, size::bigint as size, source_size, target::double as target, (copies*size)::bigint as taken, copies::bigint as copies from c
"""
