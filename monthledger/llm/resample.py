"""Importance resampling towards a target distribution of hashed n-grams.

Words and pairs of words are hashed into buckets; a bucket's gain is the log
ratio of its share in the target texts to its share in the documents. A
document's weight is the mean gain of its features, and Gumbel noise from its
id turns the weights into a draw without replacement: the highest scores.

Buckets come from an Aho-Corasick dictionary. The distinct words of a chunk of
texts, bounded by delimiters, are its patterns; each carries its CRC-32 and its
length. One scan of the chunk emits the payloads in text order, and adjacent
payloads compose: the CRC of ``a b`` is that of ``a `` moved on by the length
of ``b`` (a linear map), exclusive-or that of ``b``. No pair is ever spelled.

Every text is scanned once; its buckets are written to the shared folder, from
which the counts and then the scores are taken. Counts are summed in a task
before they are shuffled. The driver holds one gain a bucket and one count a
distinct score (whole numbers of a range of some ten thousands, whatever the
rows). Ranks come from those counts and from the order within one score.

Cases: null text has no words; a document without words has weight 0; a null
id counts as the empty string in the noise and ranks last among ties; rows of
one id and score are ordered by features and weight; repeated rows are drawn
one by one; an empty table gives an empty result, an empty target has T = 0;
columns not in ``keep`` are not read, and those named like a result column are
replaced.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthledger.llm.common import materialize, ship, table

ship(__name__)

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Bytes of text whose words share a dictionary, and bytes scanned at once.
CHUNK, SLICE = 4_000_000, 1_000_000
#: ASCII letters lower-cased, digits and all bytes above ASCII kept, the rest delimiters.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _compose(images, x):
    """The linear map with these images of the 32 bits, applied to ``x``."""
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where(x >> np.uint32(bit) & np.uint32(1), images[bit], np.uint32(0))
    return out


@lru_cache(maxsize=64)
def _power(k: int) -> np.ndarray:
    """Images of the 32 bits when 2**k zero bytes follow."""
    if k == 0:
        # crc32 of a zero byte from register r is linear in r but for a constant
        base = zlib.crc32(b"\0", 0)
        return np.array([zlib.crc32(b"\0", 1 << i) ^ base for i in range(32)], np.uint32)
    half = _power(k - 1)
    return _compose(half, half)


@lru_cache(maxsize=512)
def _tables(n: int) -> np.ndarray:
    """Four tables of 256: what each byte of a CRC becomes when n bytes follow."""
    images = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for k in range(n.bit_length()):
        if n >> k & 1:
            images = _compose(_power(k), images)
    byte = np.arange(256, dtype=np.uint32)
    out = np.zeros((4, 256), np.uint32)
    for i in range(32):
        out[i // 8] ^= np.where(byte >> np.uint32(i % 8) & np.uint32(1), images[i], np.uint32(0))
    return out


def followed_by(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each left text followed by the right one of that length."""
    out = np.empty_like(left)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)]):
        at = order[a:b]
        t, x = _tables(int(lengths[at[0]])), left[at]
        out[at] = t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]
    return out ^ right


def scan(texts: list[bytes], buckets: int = BUCKETS):
    """(words in each text, buckets of all features in text order)."""
    import ahocorasick

    line = b" " + b" ".join(t.translate(PLAIN) for t in texts) + b" "
    starts = 1 + np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    words = list(set(line.split()))
    if not words:
        return np.zeros(len(texts), np.int64), np.zeros(0, np.int32)
    crc = np.array([zlib.crc32(w) for w in words], np.uint32)
    spaced = np.array([zlib.crc32(b" ", int(c)) for c in crc], np.uint32)
    size = np.array([len(w) for w in words], np.int64)
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, w in enumerate(words):
        found.add_word(f" {w.decode('latin-1')} ", i)
    found.make_automaton()
    chars, at, hits = line.decode("latin-1"), 0, []
    while at < len(chars) - 1:
        stop = chars.find(" ", min(at + SLICE, len(chars) - 1))
        hits.append(np.fromiter(found.iter(chars[at : stop + 1]), "i8,i8"))
        hits[-1]["f0"] += at
        at = stop
    hits = np.concatenate(hits)
    word, doc = hits["f1"], np.searchsorted(starts, hits["f0"], side="right") - 1
    both = np.zeros((len(word), 2), np.uint32)
    both[:, 0] = crc[word]
    both[:-1, 1] = followed_by(spaced[word[:-1]], crc[word[1:]], size[word[1:]])
    real = np.ones((len(word), 2), bool)
    real[:, 1] = np.append(doc[:-1] == doc[1:], False)
    return np.bincount(doc, minlength=len(texts)), (both[real] % np.uint32(buckets)).astype(np.int32)


def _free(name: str, taken) -> str:
    while name in taken:
        name += "_"
    return name


def features(docs: DataFrame, keep: list[str], text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``keep`` columns, ``n_words`` and the list of feature buckets of each row."""
    kept = [c for c in keep if c not in ("n_words", "buckets")]
    schema = docs.select(*kept).schema.add("n_words", T.LongType()).add("buckets", T.ArrayType(T.IntegerType()))

    def run(batches):
        for b in batches:
            texts = [x or b"" for x in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()]
            size = np.cumsum([len(x) for x in texts])
            s = 0
            while s < len(texts):
                e = max(s + 1, int(np.searchsorted(size, (size[s - 1] if s else 0) + CHUNK)))
                n, flat = scan(texts[s:e], buckets)
                ends = np.cumsum(np.append(0, np.maximum(2 * n - 1, 0)))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                columns = [b.column(i).slice(s, e - s) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), lists], names=schema.names)
                s = e

    return docs.select(*kept, F.col(text).alias(_free("_text", kept))).mapInArrow(run, schema)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(b.column("buckets").flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in found.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of both shares, one smoothing feature a bucket."""
    k = len(corpus)
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (corpus.sum() + float(k)) / ((s + 1) * (target.sum() + float(k))))).astype(np.int64)


def resample(
    docs: DataFrame,
    target: DataFrame,
    keep: list[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every row's ``keep`` columns (default: the id; give the text to get the
    drawn documents), n_words, n_features, weight, score and rank (null: not drawn)."""
    own = ["n_words", "n_features", "weight", "score", "rank"]
    keep = [c for c in dict.fromkeys([doc_id, *(keep or [])]) if c not in own]
    found = materialize(features(docs, keep, text, buckets), "features")
    wanted = features(target, [], text, buckets)
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets)))

    def weigh(batches):
        for b in batches:
            lists = b.column("buckets")
            ends = np.cumsum(np.append(0, lists.value_lengths().to_numpy(zero_copy_only=False)))
            total = np.append(0, np.cumsum(gain.value[lists.flatten().to_numpy(zero_copy_only=False)]))[ends]
            n = np.diff(ends)
            weight = np.diff(total) // np.maximum(n, 1)
            kept = [b.column(c) for c in [*keep, "n_words"]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n, pa.int64()), pa.array(weight, pa.int64())], names=[*keep, *own[:3]])

    schema = found.drop("buckets").schema.add("n_features", T.LongType()).add("weight", T.LongType())
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000.0 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    scored = materialize(found.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + noise), "scores")
    return ranked(scored, doc_id, min_words, percent).select(*keep, *own)


def ranked(scored: DataFrame, doc_id: str, min_words: int, percent: int) -> DataFrame:
    """Ranks 1, 2, 3... of the drawn rows: rows above a score by its counts,
    rows of one score by id."""
    able = F.col("n_words") >= min_words
    counts = sorted(scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    draw, above, before = sum(r.n for r in counts) * percent // 100, [], 0
    for r in counts:
        if before >= draw:
            break
        above.append((r.score, before))
        before += r.n
    if not above:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    hit = able & (F.col("score") >= above[-1][0])
    at = scored.sparkSession.createDataFrame(above, "score long, _before long")
    order = Window.partitionBy("score").orderBy(F.col(doc_id).asc_nulls_last(), "n_features", "weight")
    rank = F.col("_before") + F.row_number().over(order)
    drawn = scored.where(hit).join(at, "score").withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return drawn.drop("_before").unionByName(scored.where(~hit).withColumn("rank", F.lit(None).cast("long")))


def op12(spark, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def _crc(x: str) -> str:
    """CRC-32 of a text, byte by byte through the column ``tab``."""
    codes = f"list_transform(range(1, strlen({x}) + 1), lambda i: cast('0x' || substr(hex(encode({x})), 2 * i - 1, 2) as ubigint))"
    step = "xor(c >> 8, tab[cast(xor(c & 255, d) as int) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::ubigint, {codes}), lambda c, d: {step}), 4294967295::ubigint)"


SQL = rf"""
with recursive bits(b, v, k) as (
  select cast(range as int), cast(range as ubigint), 0 from range(256)
  union all
  select b, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end, k + 1 from bits where k < 8
),
steps as (select list(v order by b) as tab from bits where k = 8),
texts as (
  select 0 as side, doc_id as id, row_number() over () as r, text from documents
  union all select 1, item_id, row_number() over (), text from benchmark
),
words as (
  select side, id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts
),
grams as (
  select side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from words
),
hashed as (
  select f, {_crc("f")} % 10000 as bucket from (select distinct f from grams), steps
),
featured as (select side, r, bucket from grams join hashed using (f)),
counts as (
  select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from featured group by bucket
),
totals as (select sum(s)::double as s_all, sum(t)::double as t_all from counts),
gained as (
  select bucket, cast(floor(1000 * ln((t + 1)::double * (s_all + 10000) / ((s + 1)::double * (t_all + 10000)))) as bigint) as gain
  from counts, totals
),
weighed as (
  select r, count(*) as n, cast(floor(sum(gain)::double / count(*)) as bigint) as weight
  from featured join gained using (bucket) where side = 0 group by r
),
scored as (
  select id as doc_id, len(w) as n_words, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || coalesce(cast(id as varchar), '')), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from words left join weighed using (r) where side = 0
),
places as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last, n_features, weight) as place,
    count(*) filter (n_words >= 20) over () as able from scored
)
select doc_id, cast(n_features as bigint) as n_features, weight, score,
  case when n_words >= 20 and place <= 25 * able // 100 then place end as rank
from places
"""
