"""N-gram Jaccard join as a sparse matrix product over document sets.

A document's row holds its distinct n-word shingles as 64-bit hashes. Equal
rows are collapsed first. The product runs over the columns that can decide a
pair: of a row of s shingles the first s - ceil(t * s) + 1 in one global order
(a pair at t or more shares one of them), so overlap starts from those columns
only, and pairs whose sizes alone rule out t are dropped. Very frequent
columns go last in the order. They come from bounded counts that each task
gathers while it takes the sizes, and at most ``HOT`` of them are broadcast;
the result is exact under any choice.

Groups of near copies are not expanded into pairs. Each block of a column first
meets its smallest document (a star); exact overlaps are counted for the stars,
linked documents are contracted, and only pairs in different components go on,
in products of bounded blocks (``column_pairs``).

A first pass keeps only sizes, signatures and those counts; a second one, over
one row per distinct set, writes the deciding columns and a 256-byte histogram
of the set. Histograms bound the overlap of a pair from above, so whole sets are
made, a third time, only for the documents of pairs that the bound leaves open;
the decision is the exact overlap.

Cases: null, empty or blank text: no shingles, no links. Fewer than n words:
the sequence is the one shingle. Null doc_id: a row without links, component
null. Repeated rows and equal texts share a component; rows of one doc_id with
different texts are all compared, and share one. Empty table: empty
result. Extra columns are ignored by ``components`` and kept by the stage.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthledger.llm.common import connected_components, materialize, packed, ship, table, unpacked

ship(__name__)

HOT = 200_000
HOT_DF = 100
CHUNK = 2_000_000
SKETCH = 16_384
SMALL = 32
BLOCK = 1000
HELD = 200_000
SIZES = "doc_id long, n_shingles long, sig binary, cols array<long>, counts array<long>"
DECIDING = "doc_id long, n_shingles long, sig binary, hist binary, cols array<long>"


class Words(dict):
    """Word -> its hash, computed at first sight."""

    def __missing__(self, w: bytes) -> int:
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def shingle_hashes(text: str | None, n: int, held: Words) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    a = np.fromiter(map(held.__getitem__, words), np.uint64, len(words))
    width = min(n, len(a))
    h = np.full(len(a) - width + 1, width, np.uint64)
    for k in range(width):
        h = (h ^ a[k : len(a) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    h = h.view(np.int64)
    h.sort()
    first = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=first[1:])
    return h[first]


def histogram(x: np.ndarray) -> bytes | None:
    """How many hashes fall in each of 256 classes; None if a count needs more than a byte."""
    h = np.bincount((x.view(np.uint64) >> np.uint64(56)).astype(np.int64), minlength=256)
    return h.astype(np.uint8).tobytes() if h.max() < 256 else None


def each_set(batches, n: int):
    """(doc_ids, sets) of 256 rows at a time."""
    held = Words()
    for b in batches:
        for s in range(0, b.num_rows, 256):
            part = b.slice(s, 256)
            yield part.column("doc_id"), [shingle_hashes(t, n, held) for t in part.column("text").to_pylist()]
            if len(held) > HELD:
                held = Words()


def signature(x: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(x.tobytes())


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays), pa.int64()))


def frequent(sets: list[np.ndarray]) -> pa.RecordBatch:
    """One row: the ``SKETCH`` most frequent columns that occur twice or more, and their counts.
    ``sets`` is emptied, and the columns are sorted in place: a task holds them once."""
    x = np.concatenate(sets)
    sets.clear()
    x.sort()
    starts = np.flatnonzero(np.concatenate([[len(x) > 0], x[1:] != x[:-1]])[: len(x)])
    cols, counts = x[starts], np.diff(starts, append=len(x))
    at = np.nonzero(counts > 1)[0]
    if len(at) > SKETCH:
        at = at[np.argpartition(counts[at], -SKETCH)[-SKETCH:]]
    none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary())]
    return pa.RecordBatch.from_arrays([*none, lists([cols[at]]), lists([counts[at]])], names=["doc_id", "n_shingles", "sig", "cols", "counts"])


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def sizes(docs: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, n_shingles, sig of every row, and rows without sig that hold
    columns with their counts among the unlike sets of ``CHUNK`` entries."""

    def run(batches):
        chunk, seen, held = [], set(), 0
        for ids, sets in each_set(batches, n):
            sigs = [signature(x) for x in sets]
            none = pa.nulls(len(sets), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(x) for x in sets], pa.int64()), pa.array(sigs, pa.binary()), none, none], names=["doc_id", "n_shingles", "sig", "cols", "counts"])
            for x, sig in zip(sets, sigs):
                if sig not in seen:
                    seen.add(sig)
                    chunk.append(x)
                    held += len(x)
            if held > CHUNK:
                yield frequent(chunk)
                chunk, seen, held = [], set(), 0
        if chunk:
            yield frequent(chunk)

    return numbered(docs).mapInArrow(run, SIZES)


def hot_columns(counted: DataFrame) -> np.ndarray:
    """At most ``HOT`` columns, sorted, that the tasks counted over ``HOT_DF`` times."""
    each = counted.where("sig is null").select(F.explode(F.arrays_zip("cols", "counts")).alias("c"))
    df = each.groupBy(F.col("c.cols").alias("col")).agg(F.sum("c.counts").alias("df"))
    top = df.where(F.col("df") > HOT_DF).orderBy(F.desc("df"), "col").limit(HOT)
    return np.sort(np.array([r.col for r in top.select("col").collect()], np.int64))


def chosen(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """doc_id, rows, named: of the documents that hold no distinct set (copies,
    empty texts) or whose id is repeated. ``rows``: doc_id, sig of all rows,
    ``reps``: (sig, rep)."""
    ids = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    ids = ids.join(reps.select(F.col("rep").alias("doc_id")).distinct().withColumn("named", F.lit(True)), "doc_id", "left")
    return ids.where("rows > 1 or named is null")


def deciding_columns(docs: DataFrame, ids: DataFrame, reps: DataFrame, n: int, percent: int, hot: np.ndarray) -> DataFrame:
    """Size, histogram and deciding columns of one row per distinct set.

    Texts are not shuffled: those of ``chosen`` documents are left out by the
    list of their ids, which Spark broadcasts while it is small. Rows of a
    repeated doc_id are taken by their signature.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        hot = shared.value
        for ids, sets in each_set(batches, n):
            cols = [deciding(x, len(x) - -(-percent * len(x) // 100) + 1, hot) if len(x) else x for x in sets]
            sigs, hists = [signature(x) for x in sets], [histogram(x) for x in sets]
            out = [ids, pa.array([len(x) for x in sets], pa.int64()), pa.array(sigs, pa.binary()), pa.array(hists, pa.binary()), lists(cols)]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_shingles", "sig", "hist", "cols"])

    texts = numbered(docs).where("doc_id is not null")
    once = texts.join(ids.select("doc_id"), "doc_id", "left_anti").mapInArrow(run, DECIDING)
    again = texts.join(ids.where("rows > 1 and named").select("doc_id"), "doc_id", "left_semi").mapInArrow(run, DECIDING)
    again = again.join(reps.select("sig", F.col("rep").alias("doc_id")), ["sig", "doc_id"], "left_semi").dropDuplicates(["doc_id", "sig"])
    return once.unionByName(again).drop("sig")


def whole_sets(docs: DataFrame, ids: DataFrame, repeated: DataFrame, n: int) -> DataFrame:
    """doc_id, hashes of the documents in ``ids``; unlike texts of one id each give a row."""

    def run(batches):
        for ids, sets in each_set(batches, n):
            yield pa.RecordBatch.from_arrays([ids, lists(sets)], names=["doc_id", "hashes"])

    texts = numbered(docs).join(ids, "doc_id", "left_semi")
    once = texts.join(repeated, "doc_id", "left_anti").mapInArrow(run, "doc_id long, hashes array<long>")
    again = texts.join(repeated, "doc_id", "left_semi").mapInArrow(run, "doc_id long, hashes array<long>")
    return once.unionByName(again.dropDuplicates(["doc_id", "hashes"]))


def deciding(x: np.ndarray, take: int, hot: np.ndarray) -> np.ndarray:
    """The first ``take`` columns of a row, hot ones last."""
    if not len(hot):
        return x[:take]
    common = hot[np.minimum(np.searchsorted(hot, x), len(hot) - 1)] == x
    return np.concatenate([x[~common], x[common]])[:take]


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose histograms allow an overlap that reaches the
    threshold: the class-wise minima add up to at least the true overlap."""
    x = sets.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"), F.col("hist").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("hist").alias("y"))

    def run(batches):
        for t in batches:
            for s in range(0, t.num_rows, 4096):
                b = t.slice(s, 4096)
                x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
                known = np.array([i is not None and j is not None for i, j in zip(x, y)], bool)
                n, m = b.column("n").to_numpy(zero_copy_only=False), b.column("m").to_numpy(zero_copy_only=False)
                most = np.minimum(n, m)
                grid = lambda v: np.frombuffer(b"".join(i for i, k in zip(v, known) if k), np.uint8).reshape(-1, 256)
                most[known] = np.minimum(grid(x), grid(y)).sum(axis=1, dtype=np.int64)
                keep = pa.array(100 * most >= percent * (n + m - most))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(keep)

    return pairs.join(x, "a").join(y, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


def enough_columns(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) that share enough deciding columns to reach the threshold.

    Of the set whose deciding columns end first in the global order, every
    common element among them is a deciding column of the other as well; so the
    overlap is at most the shared deciding columns and that set's other elements.
    Large sets fill all classes of their histograms, which then rule out little.
    """
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    kept = sets.join(ids, "doc_id", "left_semi").select("doc_id", "n_shingles", "cols")
    p = pairs.join(kept.toDF("a", "n", "x"), "a").join(kept.toDF("b", "m", "y"), "b")
    others = F.greatest(F.col("n") - F.size("x"), F.col("m") - F.size("y"))
    p = p.withColumn("most", F.least("n", "m", F.size(F.array_intersect("x", "y")) + others))
    return p.where(100 * F.col("most") >= percent * (F.col("n") + F.col("m") - F.col("most"))).select("a", "b").distinct()


def verified(pairs: DataFrame, sets: DataFrame, whole, percent: int) -> DataFrame:
    """Those (a, b) whose exact overlap reaches the threshold; only sets of
    pairs that pass ``possible`` and ``enough_columns`` are made, by ``whole``
    from their ids."""
    pairs = materialize(possible(pairs, sets, percent), "possible")
    pairs = materialize(enough_columns(pairs, sets, percent), "enough")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    needed = materialize(whole(materialize(ids, "ids")), "needed")
    x = needed.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x"))
    y = needed.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y"))
    p = pairs.join(x, "a").join(y, "b").withColumn("both", F.size(F.array_intersect("x", "y")))
    return p.where(100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b")


def column_pairs(q: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a > b, of different roots that share a column and may
    reach the threshold. ``q``: col, doc, n, root.

    Columns that hold the same documents are taken once. Up to ``SMALL`` rows
    of a column are paired directly; a longer column is cut in blocks of about
    ``BLOCK`` rows, a task takes the product of one pair of blocks, and only
    pairs that pass the histogram bound leave it.
    """
    q = materialize(q, "columns")
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "doc", "n")).alias(f"s{seed}")  # noqa: E731  two of 64 bits
    cols = q.groupBy("col").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("g"), mark(1), mark(2)).where("low <> high")
    cols = cols.groupBy("g", "s1", "s2").agg(F.min("col").alias("col")).select("col", "g")
    q = materialize(q.join(cols, "col"), "open")
    short, long = q.where(F.col("g") <= SMALL), q.where(F.col("g") > SMALL)
    fits = (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
    r = short.select("col", F.col("doc").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"))
    few = short.join(r, "col").where((F.col("root") != F.col("other")) & (F.col("doc") > F.col("b")) & fits).select(F.col("doc").alias("a"), "b")

    k = F.ceil(F.col("g") / BLOCK).cast("int")
    each = long.join(sets.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "hist"), ["doc", "n"])
    each = each.withColumn("k", k).withColumn("own", F.pmod(F.xxhash64("doc"), F.col("k")).cast("int"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    each = each.select("col", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "n", "root", "hist")

    def product(t):
        t = t.sort_by("own")
        own, doc, n, root = (t.column(c).to_numpy() for c in ("own", "doc", "n", "root"))
        known = np.array([v is not None for v in t.column("hist").to_pylist()], bool)
        grid = np.frombuffer(b"".join(v or bytes(256) for v in t.column("hist").to_pylist()), np.uint8).reshape(-1, 256)
        both = t.column("i")[0].as_py() != t.column("j")[0].as_py()
        half = int(np.searchsorted(own, own[0], "right"))
        left, right = (slice(0, half), slice(half, None)) if both else (slice(None), slice(None))
        out = []
        for r in np.arange(len(doc))[left]:
            m = n[right]
            open_ = (root[right] != root[r]) & (100 * np.minimum(m, n[r]) >= percent * np.maximum(m, n[r]))
            if not both:
                open_ &= doc < doc[r]
            at = np.nonzero(open_)[0]
            most = np.minimum(n[r], m[at])
            sure = known[right][at] & known[r]
            most[sure] = np.minimum(grid[right][at[sure]], grid[r]).sum(axis=1, dtype=np.int64)
            at = doc[right][at[100 * most >= percent * (n[r] + m[at] - most)]]
            out.append(np.stack([np.maximum(at, doc[r]), np.minimum(at, doc[r])]))
        a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return pa.table({"a": a, "b": b})

    many = each.groupBy("col", "i", "j").applyInArrow(product, "a long, b long")
    return few.union(many.where("a <> b")).distinct()


def link_edges(sets: DataFrame, whole, percent: int) -> DataFrame:
    """Edges (a, b) that connect exactly what all links connect. ``sets``: one
    row per distinct non-empty set, of which ``whole`` makes the hashes."""
    p = sets.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), F.explode("cols").alias("col"))
    p = p.repartition("col")  # shuffled once: the counts and the rows read the same exchange
    first = p.groupBy("col").agg(F.min(F.struct("doc", "n")).alias("s"), F.count(F.lit(1)).alias("df")).where("df > 1")
    p = materialize(p.join(first.select("col", F.col("s.doc").alias("b"), F.col("s.n").alias("m")), "col"), "prefixes")
    fits = (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
    stars = materialize(p.where((F.col("doc") != F.col("b")) & fits).select(F.col("doc").alias("a"), "b").distinct(), "pairs")
    linked = materialize(verified(stars, sets, whole, percent), "stars")
    roots = materialize(connected_components(linked), "roots")
    q = p.join(roots, F.col("doc") == F.col("node"), "left").select("col", "doc", "n", F.coalesce("root", "doc").alias("root"))
    rest = column_pairs(q, sets, percent).join(stars, ["a", "b"], "left_anti")
    return linked.union(verified(rest, sets, whole, percent))


def components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    counted = materialize(sizes(docs, n), "sizes")
    rows = counted.where("sig is not null").select("doc_id", "n_shingles", "sig")
    named = rows.where("doc_id is not null and n_shingles > 0")
    one = materialize(named.groupBy("sig").agg(F.min("doc_id").alias("rep")), "reps")
    ids = materialize(chosen(rows, one), "ids")
    sets = materialize(deciding_columns(docs, ids, one, n, percent, hot_columns(counted)), "distinct")
    edges = link_edges(sets, lambda wanted: whole_sets(docs, wanted, ids.where("rows > 1").select("doc_id"), n), percent)
    same = named.select("doc_id", "sig").join(one, "sig").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = connected_components(edges.union(same))
    out = rows.select("doc_id", "n_shingles").join(roots, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def op8(spark, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))


def jaccard_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest doc_id. Rows of
    one doc_id count once if their words are equal; if not, each stays. Rows
    without doc_id stay. Only rows of repeated ids are shuffled."""
    c = materialize(components(docs), "components")
    gone = materialize(c.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    kept = docs.select("doc_id", packed(docs).alias("row")).join(gone, "doc_id", "left_anti")
    repeated = materialize(c.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    once = kept.join(repeated, "doc_id", "left_anti")
    text = F.coalesce("row.text", F.lit(""))
    words = F.trim(F.regexp_replace(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), r"[\x20\x09-\x0D]+", " "))
    again = kept.join(repeated, "doc_id", "left_semi").withColumn("words", F.sha2(words, 256)).dropDuplicates(["doc_id", "words"])
    return unpacked(once.select("row").unionByName(again.select("row")), docs)
