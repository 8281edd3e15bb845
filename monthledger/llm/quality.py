"""Quality classifier: ordinal cumulative-link regression.

P(grade > k) = sigmoid(w . x - theta_k) with one weight vector over hashed
words and shape buckets, and ordered thresholds theta_0 < theta_1. Grades come
from the labels: 0 poor, 1 fair writing that is toxic, 2 good. It is fitted on
at most ``MAX_ROWS`` labelled documents (a documented bound, chosen by hash),
and scores every document: expected grade and P(grade = 2). A document is
kept if that tail probability is at least ``KEEP``.

Cases: null or empty text has only the bias and the "empty" shape; labels with
null doc_id or quality are left out, null toxic counts as 0, of several labels
the lowest grade counts, and of several texts of a labelled doc_id the smallest
is fitted on; without labels, or with one grade only, every document is kept;
repeated rows each get a row; extra columns are ignored, in the stage kept.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthledger.llm.common import packed, ship, table, unpacked

ship(__name__)

DIM = 1 << 18
MAX_ROWS = 8000
KEEP = 0.5
#: A word must tell this much a labelled row (chi-square over rows), and more than chance would over all words tested.
CHI2 = 0.02
CHANCE = 0.01


def features(text: str | None, held: dict) -> np.ndarray:
    """Sorted distinct buckets of the words and of the text's shape."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    out = set()
    for w in set(words):
        h = held.get(w)
        if h is None:
            h = held[w] = zlib.crc32(w.strip(b".,;:")) % (DIM - 4096) + 4096
        out.add(h)
    n, t = max(1, len(words)), text or ""
    letters = sum(map(t.count, "aeiouAEIOU")) or 1
    upper = sum(map(t.count, "AEIOU"))
    marks = sum(map(t.count, "!#$%&*|"))
    shape = [
        int(8 * min(1.0, upper / letters)), int(8 * min(1.0, marks / n)), int(8 * len(out) / n) if n < 400 else int(8 * (len(out) / n) ** 0.5),
        int(16 * max(Counter(words).values()) / n) if words else 16, min(15, n.bit_length()),
    ]
    out.update(64 * i + int(s) for i, s in enumerate(shape))
    return np.array(sorted(out), dtype=np.int32)


def fit(rows: list[tuple[np.ndarray, int]], epochs: int = 30, l2: float = 1e-4):
    """(w, theta): Adagrad on the log-likelihood over the buckets whose
    presence depends on the grade (chi-square), so rare words say nothing."""
    grades = {g for _, g in rows}
    if len(grades) < 2:
        return None
    count, y = np.zeros((3, DIM)), np.array([g for _, g in rows])
    for x, g in rows:
        count[g, x] += 1
    total, size = count.sum(axis=0), np.bincount(y, minlength=3)
    expect = total[None, :] * (size / len(y))[:, None]
    chi2 = (((count - expect) ** 2) / np.maximum(expect, 0.5)).sum(axis=0)
    tested = total >= 3
    least = max(CHI2 * len(y), 2 * np.log(max(1, tested[4096:].sum()) / CHANCE))  # two degrees of freedom: p = exp(-chi2 / 2)
    used = tested & ((chi2 >= least) | (np.arange(DIM) < 4096))
    xs = [x[used[x]] for x, _ in rows]
    share = np.bincount(y, minlength=3) / len(y)
    weight = (1 / np.maximum(share, 0.02))[y] ** 0.5
    w, sq = np.zeros(DIM), np.full(DIM, 1e-6)
    theta, tsq = np.array([-1.0, 0.0]), np.full(2, 1e-6)
    rng, sig = np.random.default_rng(0), lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            x = xs[i]
            s = w[x].sum()
            p = sig(s - theta)  # P(grade > 0), P(grade > 1)
            edge = np.array([1.0, p[0], p[1], 0.0])
            g = y[i]
            like = max(edge[g] - edge[g + 1], 1e-6)
            d = np.array([0.0, p[0] * (1 - p[0]), p[1] * (1 - p[1]), 0.0])
            slope = weight[i] * (d[g] - d[g + 1]) / like
            gx = -slope + l2 * w[x]
            sq[x] += gx * gx
            w[x] -= 0.1 * gx / np.sqrt(sq[x])
            gt = np.zeros(2)
            if g > 0:
                gt[g - 1] += weight[i] * d[g] / like
            if g < 2:
                gt[g] -= weight[i] * d[g + 1] / like
            tsq += gt * gt
            theta = theta - 0.1 * gt / np.sqrt(tsq)
            theta[1] = max(theta[1], theta[0] + 1e-3)
    return w.astype(np.float32), theta


def graded(labels: DataFrame) -> DataFrame:
    g = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    rows = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("_id"), g.alias("grade"))
    return rows.groupBy("_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS):
    chosen = graded(labels).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))  # at most max_rows texts

    def prepare(batches):
        held = {}
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "x": [features(t, held) for t in b["text"]], "grade": b["grade"]})

    x = rows.mapInPandas(prepare, "doc_id long, x array<int>, grade int")
    got = x.orderBy("doc_id").limit(max_rows).collect()
    return fit([(np.array(r.x, np.int32), r.grade) for r in got])


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row of docs as struct ``row``, and ``_score``: expected_grade, p_top and kept."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))

    @F.pandas_udf("expected_grade double, p_top double, kept boolean")
    def score(texts: pd.Series) -> pd.DataFrame:
        if model.value is None:
            n = len(texts)
            return pd.DataFrame({"expected_grade": [2.0] * n, "p_top": [1.0] * n, "kept": [True] * n})
        (w, theta), held = model.value, {}
        s = np.array([w[x].sum() for x in (features(t, held) for t in texts)])
        p = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None, :], -30, 30))) if len(s) else np.zeros((0, 2))
        return pd.DataFrame({"expected_grade": p.sum(axis=1), "p_top": p[:, 1], "kept": p[:, 1] >= KEEP})

    return docs.select(packed(docs).alias("row"), score("text").alias("_score"))


def op7(spark, sf_dir: str) -> DataFrame:
    scored = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "_score.*")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return unpacked(classify(docs, table(spark, sf_dir, "labels")).where("_score.kept"), docs)
