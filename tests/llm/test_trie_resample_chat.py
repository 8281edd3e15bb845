"""Prefix trie, importance resampling and chat examples against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from monthledger.llm import chat, resample, trie

CONV = "conv_id long, turn long, role string, text string, n_convs string, weight int, example string, _z_depth int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None, 2) for r in rows], CONV)


def made(n, seed):
    """Conversations that share beginnings: copies, a long chain, nulls, gaps."""
    r = random.Random(seed)
    rows = []
    for c in range(n):
        if r.random() < 0.1:
            continue
        base = r.choice([0, 0, 1, 2])
        for t in range(r.randrange(1, 9)):
            role = "user" if t % 2 == 0 else "assistant"
            rows.append((c, t, role if r.random() > 0.05 else None, None if r.random() < 0.05 else f"t{base}{t if r.random() < 0.8 else c}"))
    rows += [(c, t, "user", f"deep {t}") for c in (700, 1500) for t in range(60 if c == 700 else 45)]
    rows += [(c, t, "user", f"copy {t}") for c in range(3000, 3040) for t in range(6)]
    rows += [(4101, None, "user", "first"), (4101, 0, "user", "é" * 5), (4101, 0, "user", "é" * 5), (4202, 0, None, None)]
    r.shuffle(rows)
    return rows


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        convs[c].append(((turn is not None, turn or 0), mark, (role, text)))
    convs = {c: [x[2] for x in sorted(t)] for c, t in convs.items() if c is not None}
    full = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(convs.get(c - c % 100, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, s in sorted(full.items()):
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += kids[s] == 0
            saved[s[:d]] += (len(m) - 1) * (len(s[-1][1]) if s else 0)
    out = set()
    for s, m in members.items():
        ends = ",".join(str(c) for c in m if full[c] == s)
        up = members[s[:-1]][0] if s else None
        out.add((m[0], len(s), up, len(m), kids[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("local", [12, trie.LOCAL])
def test_trie_equals_brute_force(spark, local):
    rows = made(400, 3) + [(None, 0, "user", "nobody's")]
    got = trie.trie(trie.rebuilt(trie.turn_digests(conversations(spark, rows))), local).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute_trie(rows)


def test_trie_edges(spark):
    empty = conversations(spark, [(1, 0, "user", "x")]).limit(0)
    assert trie.trie(trie.rebuilt(trie.turn_digests(empty))).count() == 0
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6)
    short = [(c, 0, "user", "gone")]  # h is over 0 and there is no base: turnless
    got = trie.trie(trie.rebuilt(trie.turn_digests(conversations(spark, short)))).collect()
    assert {tuple(r) for r in got} == brute_trie(short)
    assert [tuple(r)[:6] for r in got] == [(c, 0, None, 1, 0, 1)]


def test_split_locally_on_odd_trees():
    r = random.Random(5)
    for n in (1, 2, 3, 50, 300):
        for shape in ("chain", "star", "random"):
            parent = [-1] + [{"chain": i - 1, "star": 0, "random": r.randrange(i)}[shape] for i in range(1, n)]
            value = [[r.randrange(9), r.randrange(99)] for _ in range(n)]
            want, weight = np.array(value), [1] * n
            for i in range(n - 1, 0, -1):
                want[parent[i]] += want[i]
                weight[parent[i]] += weight[i]
            assert (trie.split_locally(parent, weight, np.array(value)) == want).all()


def test_end_lists_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 50)
    rows = spark.range(2000).selectExpr("id % 3 as k", "id as v")
    got = {r.k: r.ends_sha256 for r in trie.joined_hashes(rows, ["k"], "v").collect()}
    assert got == {k: hashlib.sha256(",".join(str(i) for i in range(2000) if i % 3 == k).encode()).hexdigest() for k in range(3)}


# ------------------------------------------------------------- resampling --

DOCS = "doc_id long, text string, score string, buckets int, _text string"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_resample(docs, target, buckets=10_000, min_words=20, percent=25, seed=7):
    def found(text):
        w = words_of(text)
        return [zlib.crc32(x.encode()) % buckets for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = Counter(b for _, x in docs for b in found(x)), Counter(b for x in target for b in found(x))
    total, wanted, out = sum(s.values()), sum(t.values()), []
    for i, x in docs:
        f = found(x)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in f]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(x))])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return Counter((*r[:4], rank.get(id(r))) for r in out)


def texts(seed, n):
    r = random.Random(seed)
    words = ["the", "Ünder", "日本", "a", "x1", "O'Neil", "naïve", "y" * 700, "\U0001f600", "b-c", " ", "q"]
    return [r.choice([" ", "\n", "  ", "--", "\x7f"]).join(r.choice(words) for _ in range(r.randrange(0, 60))) for _ in range(n)]


def test_resample_equals_brute_force(spark, monkeypatch):
    docs = list(enumerate(texts(1, 300))) + [(5, "one two " * 30), (5, "one two " * 30), (None, "null id " * 15), (None, "null id " * 15), (900, None), (901, ""), (902, " \n.")]
    target = texts(2, 40) + [None, ""]
    monkeypatch.setattr(resample, "CHUNK", 3000)
    monkeypatch.setattr(resample, "SLICE", 100)
    d = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS)
    b = spark.createDataFrame([(t,) for t in target], "text string")
    rows = resample.resample(d, b).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(tuple(r) for r in rows) == brute_resample(docs, target)
    drawn = resample.resample(d, b, keep=["text", "_text"]).where("rank is not null").collect()
    assert {(r.doc_id, r.text) for r in drawn} <= set(docs) and all(r["_text"] == "y" for r in drawn)


def test_resample_edges(spark):
    d = spark.createDataFrame([(i, f"w{i} " * 25, "x", 1, "y") for i in range(8)], DOCS)
    b = spark.createDataFrame([("w1 w1 w1",)], "text string")
    assert resample.resample(d.limit(0), b).count() == 0
    none = resample.resample(d, b.limit(0)).collect()
    want = brute_resample([(r.doc_id, r.text) for r in d.collect()], [])
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in none) == want
    assert resample.resample(d, b, percent=0).where("rank is not null").count() == 0
    assert sorted(r["rank"] for r in resample.resample(d, b, percent=100).collect()) == list(range(1, 9))


def test_payloads_compose():
    r = np.random.RandomState(0)
    left, right = [r.bytes(k % 40) for k in range(300)], [r.bytes(k * k % 5000) for k in range(300)]
    crc = lambda x: np.array([zlib.crc32(b) for b in x], np.uint32)
    got = resample.followed_by(crc(left), crc(right), np.array([len(x) for x in right]))
    assert list(got) == [zlib.crc32(a + b) for a, b in zip(left, right)]


# ------------------------------------------------------------ chat format --


def brute_chat(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for c, t in convs.items():
        t = [x[1:] for x in sorted(t)]
        loss = "".join(x for role, x in t if role == "assistant")
        turns = "".join(f"{a}\n{b}\n" for a, b in t)
        out[c] = (len(t), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


HARD = [chat.HOSTILE, "<|", "<\\|", "<\\\\|x", "|>", "<", "\\", "<|im_sep|>\n", "a<|im_end|>\n<|im_start|>user<|im_sep|>b", "", "é日\U0001f600", "<" * 5 + "|" * 5]


def test_escapes_turn_back():
    for a in HARD:
        for b in HARD:
            assert chat.unescape(chat.escape(a + b)) == a + b and "<|" not in chat.escape(a + b)


def test_chat_reads_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "BATCH", 100)
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant", "system", chat.HOSTILE, None, "assistant<"]), r.choice([*HARD, None])) for c in range(60) for t in range(r.randrange(1, 12))]
    rows += [(70, 0, "user", "x" * 300_000), (70, 1, "assistant", "y<|" * 100_000), (None, 3, "assistant", "no id"), (80, None, "assistant", "b"), (80, None, "assistant", "a"), (80, 0, "assistant", "a"), (80, 0, "assistant", "a")]
    r.shuffle(rows)
    made = chat.expand(conversations(spark, rows))
    for ordered in (True, False):
        got = {x.conv_id: tuple(x)[1:5] for x in chat.read_back(made, ordered).collect()}
        assert got == brute_chat(rows)
    want, shown = brute_chat(rows), Counter()
    for x in made.collect():
        shown[x.conv_id] += 1
        loss = x.text[x.loss_start : x.loss_end]
        assert x.text[x.loss_end :] in ("", chat.END) and x.text[: x.loss_start].count(chat.START) == x.n_turns
        assert (x.loss_end < len(x.text)) == x.text[: x.loss_start].endswith(chat.START + "assistant" + chat.SEP), loss
    assert set(shown) == set(want)
    assert chat.read_back(chat.expand(conversations(spark, rows).limit(0)), True).count() == 0


def test_every_reply_is_one_example(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(7)]
    got = chat.expand(conversations(spark, rows)).orderBy("example").collect()
    assert [(x.n_turns, x.text[x.loss_start : x.loss_end]) for x in got] == [(2, "t1"), (4, "t3"), (6, "t5"), (7, "")]
    assert got[1].text.startswith(got[0].text) and got[0].text == "<|im_start|>user<|im_sep|>t0<|im_end|>\n<|im_start|>assistant<|im_sep|>t1<|im_end|>\n"
