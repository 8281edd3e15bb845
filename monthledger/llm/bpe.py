"""Byte-level BPE encoding and decoding in numpy matrices.

Texts are cut by the tokenizer's pattern; the distinct pieces of a batch are
sorted into length buckets and padded to one matrix per bucket. In each round
every row looks up all its adjacent pairs in a hash table, merges its leftmost
pair of least rank, and closes the gap; rows that have no pair left leave the
matrix. Pieces longer than ``LONGEST`` bytes would need a round per byte over
wide rows, so they merge by the same rule with a heap (exact at any length).

Cases: null text is empty and has no ids; ids outside the vocabulary raise;
repeated rows each get a row; an empty table gives an empty result; extra
columns are kept (``ids`` and ``decoded`` are replaced).
"""

from __future__ import annotations

import base64
import heapq
import itertools
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthledger.llm.common import ship, table

ship(__name__)

LONGEST = 256
CACHE = 300_000
FILE = "byte_bpe_multi_50k.tiktoken"


def tables(data: bytes) -> dict:
    """What tasks need of a rank file, as arrays: tokens by rank (bytes and
    ends), the rank of each byte, and the hash table from (left, right) ranks
    to the merged one. Built once, on the driver."""
    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    p = np.array(pairs, dtype=np.int64).reshape(-1, 3)
    keys, merged = p[:, 0] << 32 | p[:, 1], p[:, 2]
    bits = max(4, int(np.ceil(np.log2(len(keys) * 4 + 1))))
    table, vals = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
    at, left = slots(keys, bits), np.arange(len(keys))
    while len(left):  # linear probing, all keys at once: the first key at a free slot stays
        s = at[left]
        free = table[s] == -1
        first = np.zeros(len(left), bool)
        first[np.unique(np.where(free, s, -1), return_index=True)[1]] = True
        put = free & first
        table[s[put]], vals[s[put]] = keys[left[put]], merged[left[put]]
        left = left[~put]
        at[left] = (at[left] + 1) & ((1 << bits) - 1)
    byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
    return {"byte": byte, "bits": bits, "keys": table, "vals": vals, **token_bytes(tokens)}


def token_bytes(tokens: list[bytes]) -> dict:
    return {"token_bytes": np.frombuffer(b"".join(tokens), np.uint8), "token_ends": np.cumsum([0, *map(len, tokens)])}


def slots(keys, bits: int):
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def gather(flat: np.ndarray, ends: np.ndarray, at: np.ndarray):
    """(the pieces ``at`` of ``flat``, one after the other, their ends);
    piece i is flat[ends[i]:ends[i + 1]]."""
    sizes = (ends[1:] - ends[:-1])[at]
    stops = np.cumsum(sizes)
    if not len(at):
        return flat[:0], stops
    return flat[np.repeat(ends[at] - (stops - sizes), sizes) + np.arange(stops[-1])], stops


class Vocabulary:
    """Encodes texts by the arrays of ``tables``; remembers pieces it has met."""

    def __init__(self, data, pattern: str):
        held = data if isinstance(data, dict) else tables(data)
        self.byte, self.bits, self.keys, self.vals = (held[k] for k in ("byte", "bits", "keys", "vals"))
        self.token_bytes, self.token_ends = held["token_bytes"], held["token_ends"]
        self.cut = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @cached_property
    def tokens(self) -> list[bytes]:
        whole = self.token_bytes.tobytes()
        return [whole[a:b] for a, b in zip(self.token_ends, self.token_ends[1:])]

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        return {t: r for r, t in enumerate(self.tokens) if t}

    def slot(self, keys):
        return slots(keys, self.bits)

    def lookup(self, a, b):
        """Rank of each merged pair, or a value above all ranks."""
        none = np.int32(2**31 - 1)
        keys = a.astype(np.int64) << 32 | b.astype(np.int64)
        out, todo, s = np.full(keys.shape, none, np.int32), np.nonzero((a >= 0) & (b >= 0)), None
        k = keys[todo]
        s = self.slot(k)
        at = np.arange(len(k))
        flat = np.full(len(k), none, np.int32)
        while len(at):
            here = self.keys[s]
            hit = here == k[at]
            flat[at[hit]] = self.vals[s[hit]]
            go = ~hit & (here != -1)
            at, s = at[go], (s[go] + 1) & ((1 << self.bits) - 1)
        out[todo] = flat
        return out

    def merge_rows(self, rows: list[bytes]) -> list[np.ndarray]:
        n, width = len(rows), max(map(len, rows))
        lens = np.array([len(r) for r in rows])
        raw = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(n, width)
        m = np.where(np.arange(width) < lens[:, None], self.byte[raw], -1)
        rank = self.lookup(m[:, :-1], m[:, 1:]) if width > 1 else np.zeros((n, 0), np.int32)
        done, live, left = [None] * n, np.arange(n), lens.copy()
        none = 2**31 - 1
        while len(live):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(live), np.int64)
            best = rank[np.arange(len(live)), at] if rank.shape[1] else np.full(len(live), none)
            over = best == none
            if over.any():
                for i in np.nonzero(over)[0]:
                    done[live[i]] = m[i, : left[i]].copy()
                keep = ~over
                live, left, m, rank, at, best = live[keep], left[keep], m[keep], rank[keep], at[keep], best[keep]
                if not len(live):
                    break
            r = np.arange(len(live))
            m[r, at] = best
            left = left - 1
            width = int(left.max())
            # compaction of the ids, and of the ranks but for the pairs beside the merge
            cols = np.arange(width)
            m = np.where(cols <= at[:, None], m[:, :width], m[:, 1 : width + 1])
            rank = np.where(cols[: width - 1] < at[:, None], rank[:, : width - 1], rank[:, 1:width])
            for beside, ok in ((at - 1, at > 0), (at, at + 1 < left)):
                x, y = r[ok], beside[ok]
                rank[x, y] = self.lookup(m[x, y], m[x, y + 1])
        return done

    def merge_long(self, piece: bytes) -> np.ndarray:
        ids = [int(self.byte[x]) for x in piece]
        nxt, prev = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank = lambda a, b: self.ranks.get(self.tokens[ids[a]] + self.tokens[ids[b]])
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := rank(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[j] < len(ids):
                prev[nxt[j]] = i
            for x, y in ((prev[i], i), (i, nxt[i])):
                if x >= 0 and y < len(ids) and (q := rank(x, y)) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def learn(self, pieces) -> None:
        buckets: dict[int, list[str]] = {}
        for p in pieces:
            buckets.setdefault(max(2, 1 << (len(p.encode()) - 1).bit_length()), []).append(p)
        found = []
        for width, group in buckets.items():
            step = max(1, 2**18 // width)
            for s in range(0, len(group), step):
                part = group[s : s + step]
                raw = [p.encode() for p in part]
                found += map(self.merge_long, raw) if width > LONGEST else self.merge_rows(raw)
                self.known.update(zip(part, range(len(self.known), len(self.known) + len(part))))
        if found:
            self.flat = np.concatenate([self.flat, *found])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(f) for f in found])])

    def encode_flat(self, texts: list[str]):
        """(ids of all texts, one after the other; end of each text's ids)."""
        cut = [self.cut.findall(t) for t in texts]
        if len(self.known) > CACHE:
            self.forget()
        known = self.known
        self.learn({p for c in cut for p in c if p not in known})
        at = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(cut)), np.int64)
        ids, stops = gather(self.flat, self.ends, at)
        return ids, np.append(0, stops)[np.cumsum([0, *map(len, cut)])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, ends = self.encode_flat(texts)
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


def load(path: str | None = None, pattern: str | None = None) -> tuple[bytes, str]:
    """The rank file's bytes and the pattern (defaults: the public tokenizer)."""
    import public_tokenizers

    with open(path or public_tokenizers.path(FILE), "rb") as f:
        return f.read(), pattern or public_tokenizers.PATTERN


#: Rows that a task encodes or decodes at a time.
STEP = 200


def sliced(batches):
    for b in batches:
        for s in range(0, b.num_rows, STEP):
            yield b.slice(s, STEP)


def id_lists(v: Vocabulary, texts: pa.Array) -> pa.ListArray:
    ids, ends = v.encode_flat([t or "" for t in texts.to_pylist()])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def bytes_of(lists: pa.ListArray, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes that each list of ids stands for; token i is flat[ends[i]:ends[i + 1]]."""
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    raw, stops = gather(flat, ends, lists.flatten().to_numpy(zero_copy_only=False))
    at = np.append(0, stops)[np.cumsum(np.append(0, sizes))]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


def encode(df: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds the token ids of ``text``; the rank file is read on the driver and broadcast.

    ``decoded``: also adds, in a column of this name, the bytes that the ids
    stand for, as ``decode`` does, but in the same Python worker: a ``decode``
    after it would hold a second one for each task."""
    data, pattern = load(path, pattern)
    shared = df.sparkSession.sparkContext.broadcast((tables(data), pattern))
    kept = [c for c in df.columns if c not in (out, decoded)]
    schema = df.select(*kept).schema.add(out, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add(decoded, T.BinaryType())

    def run(batches):
        v = Vocabulary(*shared.value)
        for part in sliced(batches):
            added = [id_lists(v, part.column(text))]
            if decoded:
                added.append(bytes_of(added[0], v.token_bytes, v.token_ends))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *added], names=schema.names)

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def decode(df: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for."""
    tokens = tables(load(path)[0])
    shared = df.sparkSession.sparkContext.broadcast((tokens["token_bytes"], tokens["token_ends"]))
    kept = [c for c in df.columns if c != out]
    schema = df.select(*kept).schema.add(out, T.BinaryType())

    def run(batches):
        flat, ends = shared.value
        for part in sliced(batches):
            back = bytes_of(part.column(ids), flat, ends)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], back], names=[*kept, out])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    return with_digests(docs).drop("ids")


def with_digests(docs: DataFrame) -> DataFrame:
    both = encode(docs.select("doc_id", "text"), decoded="decoded")
    return both.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op6(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def bpe_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: every document's ids, their digest and that of the bytes they stand for."""
    return with_digests(docs)
