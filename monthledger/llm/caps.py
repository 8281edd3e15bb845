"""Embedding near-duplicates by spherical-cap filters.

The filters are structured random product codes, ``turns`` independent ones: in
each the space is rotated and cut into ``parts`` blocks, each block has a random
subcode of ``code`` directions, and a filter is one direction of every block. A
vector belongs to all filters whose inner product with it exceeds ``alpha``, and
to the ``LEAST`` best ones of the first code if those are fewer; they are
list-decoded block by block with the best rest as a bound, never by trying all
products. ``alpha`` is set for each dimension from the share ``RECALL`` of the
pairs at the threshold that must share a filter of some code: several codes
reach it at a higher alpha than one, so fewer unlike vectors meet. Vectors
meet in shared filters and every pair there is verified in double precision,
once, in the smallest filter they share. Only vectors move: links are few, so
the filters of linked rows are decoded again where the link is found (inner
products are rounded to ``DIGITS`` decimals, so every task decodes alike). Large filters are cut in blocks of
``block`` rows, and a task takes one pair of blocks; it returns counts and
local components, never pairs. Equal vectors are first collapsed.

Cases: null id, null vector, null or non-finite component, zero vector: no
links. Vectors of another length than most compare only with their own length.
Repeated rows are vectors of their own. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthledger.llm.common import connected_components, materialize, ship, table

ship(__name__)

#: Share of the pairs at the threshold that share a filter, pairs drawn to set alpha by it, filters of every vector.
RECALL = 0.999
DRAWN = 4000
LEAST = 8
DIGITS = 9
#: Dimensions whose alpha the driver sets beforehand; tasks set that of any other.
KNOWN = 32
#: Decoded rows that a task remembers.
HELD = 20_000


class Code:
    def __init__(self, dim: int, parts: int, code: int, alpha: float | None, seed: int, threshold: float = 0.9, turns: int = 8):
        rng = np.random.default_rng([seed, dim])
        self.parts = max(1, min(parts, dim))
        self.size, self.turns = code, turns
        cuts = np.array_split(np.arange(dim), self.parts)
        directions = []
        for _ in range(turns):
            rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            for cut in cuts:
                c = rng.standard_normal((code, len(cut)))
                directions.append(rotation[:, cut] @ (c / np.linalg.norm(c, axis=1, keepdims=True) * np.sqrt(len(cut) / dim)).T)
        self.directions = np.concatenate(directions, axis=1)
        self.alpha = self.level(dim, threshold, np.random.default_rng([seed, dim, 1])) if alpha is None else alpha

    def dots(self, x: np.ndarray) -> np.ndarray:
        """Inner products by row, turn, block and direction."""
        return np.round(x @ self.directions, DIGITS).reshape(len(x), self.turns, self.parts, self.size)

    def level(self, dim: int, threshold: float, rng) -> float:
        """The alpha at which ``RECALL`` of random pairs at the threshold share
        a filter: a quantile of the best level that both rows of a pair reach."""
        x, z = rng.standard_normal((2, DRAWN, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(axis=1, keepdims=True) * x
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * np.divide(z, norm, out=np.zeros_like(z), where=norm > 1e-9)
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        best = np.empty(DRAWN)
        for i in range(DRAWN):
            dx, dy = self.dots(x[i : i + 1])[0], self.dots(y[i : i + 1])[0]
            good = (dx + dy).argmax(axis=2)[..., None]  # one filter of a high level in each code bounds the best from below
            low = np.minimum(*(np.take_along_axis(d, good, 2).sum(axis=(1, 2)) for d in (dx, dy))).max()
            for tx, ty in zip(dx, dy):
                rx, ry = (np.append(np.cumsum(t.max(axis=1)[::-1])[::-1][1:], 0.0) for t in (tx, ty))
                sx, sy = np.zeros(1), np.zeros(1)
                for k in range(self.parts):
                    sx, sy = (sx[:, None] + tx[k]).ravel(), (sy[:, None] + ty[k]).ravel()
                    keep = np.minimum(sx + rx[k], sy + ry[k]) >= low - 1e-9
                    sx, sy = sx[keep], sy[keep]
                low = np.minimum(sx, sy).max(initial=low)
            best[i] = low
        return float(np.sort(best)[int((1 - RECALL) * DRAWN)]) - 1e-8

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """Filters of each row: sums of one product per block over alpha."""
        out = []
        for dots in self.dots(x):
            found = []
            for turn, d in enumerate(dots):
                rest = np.append(np.cumsum(d.max(axis=1)[::-1])[::-1][1:], 0.0)
                ids, sums = np.full(1, turn), np.zeros(1)
                for k in range(self.parts):
                    a = np.flatnonzero(sums + d[k].max() + rest[k] >= self.alpha)
                    s = sums[a, None] + d[k][None, :]
                    i, b = np.nonzero(s >= self.alpha - rest[k])
                    ids, sums = ids[a][i] * self.size + b, s[i, b]
                found.append(ids)
            ids = np.concatenate(found)
            out.append(np.unique(ids if len(ids) >= LEAST else np.concatenate([ids, self.best(dots[0])])))
        return out

    def best(self, dots: np.ndarray) -> np.ndarray:
        """The ``LEAST`` best filters of a row in the first code; a best sum has best parts."""
        ids, sums = np.zeros(1, np.int64), np.zeros(1)
        for d in dots:
            ids, sums = (ids[:, None] * self.size + np.arange(self.size)).ravel(), (sums[:, None] + d).ravel()
            top = np.argsort(-sums, kind="stable")[:LEAST]
            ids, sums = ids[top], sums[top]
        return ids


class Decoded:
    """Filters of rows by their id, decoded when first asked for."""

    def __init__(self, code: Code):
        self.code, self.held = code, {}

    def __call__(self, ids, x):
        new = [k for k, i in enumerate(ids) if i not in self.held]
        if len(self.held) > HELD:
            self.held, new = {}, list(range(len(ids)))
        for s in range(0, len(new), 256):
            part = new[s : s + 256]
            self.held.update(zip((ids[k] for k in part), self.code.decode(x[part])))
        return [self.held[i] for i in ids]


def _unit(vectors):
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _link(x, y, ids, others, filters, own, threshold, same):
    """Boolean links, each in the smallest filter that both rows have."""
    link = x @ y.T >= threshold
    if same:
        np.fill_diagonal(link, False)
    a, b = np.nonzero(link)
    if len(a):
        left, right = np.unique(a), np.unique(b)
        fx, fy = filters(ids[left], x[left]), filters(others[right], y[right])
        i, j = np.searchsorted(left, a), np.searchsorted(right, b)
        first = np.array([np.intersect1d(fx[k], fy[m], assume_unique=True)[0] for k, m in zip(i, j)]) if len(a) < 2000 else _first(fx, fy, i, j)
        keep = first == own
        link[a[~keep], b[~keep]] = False
    return link


def _first(fx, fy, a, b):
    """Smallest common filter of many pairs, through a filter-by-row table."""
    names = np.unique(np.concatenate([*fx, *fy]))
    left, right = np.zeros((len(fx), len(names)), bool), np.zeros((len(fy), len(names)), bool)
    for m, f in ((left, fx), (right, fy)):
        for i, v in enumerate(f):
            m[i, np.searchsorted(names, v)] = True
    out = np.empty(len(a), np.int64)
    for s in range(0, len(a), 20_000):
        out[s : s + 20_000] = names[(left[a[s : s + 20_000]] & right[b[s : s + 20_000]]).argmax(axis=1)]
    return out


def cap_links(vectors: DataFrame, threshold: float = 0.9, parts: int = 2, code: int = 128, alpha: float | None = None, block: int = 500, seed: int = 7, turns: int = 8):
    """(distinct vectors (vec, weight), counts (vec, n), edges (a, b))."""
    v = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0")
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    v = v.where(good).groupBy("embedding").agg(F.min("vec_id").alias("vec"), F.count(F.lit(1)).alias("weight"))
    v = materialize(v, "vectors")
    kind = v.schema["embedding"].dataType.simpleString()

    spark = v.sparkSession
    lengths = sorted(r[0] for r in v.select(F.size("embedding")).distinct().limit(KNOWN).collect()) if alpha is None else []
    levels = spark.sparkContext.broadcast({dim: Code(dim, parts, code, None, seed, threshold, turns).alpha for dim in lengths})

    def code_of(dim):
        return Code(dim, parts, code, levels.value.get(dim, alpha), seed, threshold, turns)

    def filters(batches):
        codes = {}
        for b in batches:
            dims = b["embedding"].map(len)
            for dim, g in b.groupby(dims):
                c = codes[dim] = codes.get(dim) or code_of(dim)
                for s in range(0, len(g), 256):
                    h = g.iloc[s : s + 256]
                    f = c.decode(_unit(h["embedding"]))
                    yield pd.DataFrame({"vec": h["vec"].values, "weight": h["weight"].values, "dim": dim, "embedding": h["embedding"].values, "filters": f})

    rows = v.mapInPandas(filters, f"vec long, weight long, dim int, embedding {kind}, filters array<long>")
    rows = materialize(rows, "decoded")
    each = rows.select("vec", "weight", "dim", "embedding", F.explode("filters").alias("filter"))
    sizes = rows.select("dim", F.explode("filters").alias("filter")).groupBy("dim", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    each = each.join(sizes, ["dim", "filter"])
    k = F.ceil(F.col("n") / block).cast("int")
    each = each.withColumn("k", k).withColumn("own", F.pmod(F.xxhash64("vec"), F.col("k")).cast("int"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    each = each.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def verify(filters, own, i, j, g):
        x, ids, w = _unit(g["embedding"]), g["vec"].to_numpy(), g["weight"].to_numpy()
        if i == j:
            link = _link(x, x, ids, ids, filters, own, threshold, True)
        else:
            a, b = np.nonzero(g["own"].to_numpy() == i)[0], np.nonzero(g["own"].to_numpy() == j)[0]
            link = np.zeros((len(ids), len(ids)), bool)
            if len(a) and len(b):
                part = _link(x[a], x[b], ids[a], ids[b], filters, own, threshold, False)
                link[np.ix_(a, b)] = part
                link |= link.T
        if not link.any():
            return None
        n, label = link @ w, np.arange(len(ids))
        while True:
            low = np.minimum(label, np.where(link, label[None, :], len(ids)).min(axis=1, initial=len(ids)))
            if (low == label).all():
                break
            label = low
        hit = link.any(axis=1)
        return pd.DataFrame({"vec": ids[hit], "n": n[hit].astype(np.int64), "low": ids[label[hit]]})

    names = ["dim", "filter", "i", "j"]

    def stream(batches):
        """Whole groups of the sorted partition; only the last one waits."""
        rest, known = None, {}

        def check(key, g):
            known[key[0]] = known.get(key[0]) or Decoded(code_of(int(key[0])))
            return verify(known[key[0]], *key[1:], g)

        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            keys = b[names].to_numpy()
            starts = np.concatenate([[0], np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1])
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s > 1 and (out := check(keys[s], b.iloc[s:e])) is not None:
                    yield out
            rest = b.iloc[starts[-1] :]
        if rest is not None and len(rest) > 1 and (out := check(rest[names].to_numpy()[0], rest)) is not None:
            yield out

    each = each.drop("k", "other", "n").repartition(*names).sortWithinPartitions(*names)
    found = each.mapInPandas(stream, "vec long, n long, low long")
    found = materialize(found, "links")
    return v, found.groupBy("vec").agg(F.sum("n").alias("n")), found.select(F.col("vec").alias("a"), F.col("low").alias("b"))


def near_vectors(vectors: DataFrame, **kw) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    v, counts, edges = cap_links(vectors, **kw)
    roots = connected_components(edges)
    v = v.join(counts, "vec", "left").join(roots, F.col("vec") == F.col("node"), "left")
    v = v.select("embedding", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("root", "vec").alias("root"))
    v = v.withColumnRenamed("embedding", "_e")
    out = vectors.select("vec_id", "embedding").join(v, (F.col("embedding") == F.col("_e")) & F.col("vec_id").isNotNull(), "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
with recursive e as (select vec_id, embedding::double[] as x from embeddings),
l as (select a.vec_id as a, b.vec_id as b from e a join e b on a.vec_id <> b.vec_id and list_cosine_similarity(a.x, b.x) >= 0.9),
r(a, b) as (select vec_id, vec_id from e union select r.a, l.b from r join l on l.a = r.b),
c as (select a, min(b) as component_id from r group by a)
select vec_id, (select count(*) from l where l.a = vec_id)::bigint as n_links, component_id, vec_id = component_id as kept
from e join c on c.a = vec_id
"""
