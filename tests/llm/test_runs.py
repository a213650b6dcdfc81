"""Periodic runs of words against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF
from text_rows import DOCS, edge_docs, no_docs  # noqa: F401
from faremill.llm import common, word_runs


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(w, least=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)  # smaller periods come first
            i = j
    # a stretch of a multiple of a smaller period lies in that period's stretch
    return sorted((a, b - a, q) for (a, b), q in found.items()
                  if not any(p < q and q % p == 0 and x <= a and b <= y
                             for (x, y), p in found.items()))


def test_grouping_gives_the_lyndon_array_of_both_orders():
    draw = random.Random(1)
    for _ in range(600):
        s = [draw.randint(0, draw.choice([1, 2, 5])) for _ in range(draw.randint(0, 40))]
        assert word_runs.lyndon_lengths(s) == plain_lyndon(s), s
        turned = [-x for x in s]
        assert word_runs.lyndon_lengths(turned) == plain_lyndon(turned), s
    for s in (list(range(500)), list(range(500, 0, -1)), [0] * 500, [0, 1] * 250, [1, 0, 0] * 99):
        assert word_runs.lyndon_lengths(s) == plain_lyndon(s)


def built(draw):
    w = []
    while len(w) < draw.randint(1, 120):
        piece = [draw.randint(0, 3) for _ in range(draw.randint(1, 7))]
        w += piece * draw.randint(1, 7) + piece[:draw.randint(0, len(piece))]
        w += [draw.randint(0, 6) for _ in range(draw.randint(0, 5))]
    return w


def test_runs_against_all_periods():
    draw = random.Random(2)
    some = 0
    for _ in range(1200):
        w = built(draw)
        want = plain_runs(w)
        some += len(want)
        assert word_runs.runs_of(np.array(w)) == want, w
    assert some > 1000


def test_segments_lose_no_run():
    draw = random.Random(3)
    for _ in range(60):
        texts = [[b"%d" % x for x in built(draw)] if draw.random() < .8 else []
                 for _ in range(draw.randint(1, 20))]
        assert word_runs.batch_runs(texts) == [plain_runs(t) for t in texts]


def test_long_repetitions_take_no_quadratic_time():
    words = np.array([0] * 60_000 + [1, 2] * 30_000 + [1] + list(range(5, 3000)) * 5)
    assert (0, 60_000, 1) in word_runs.runs_of(words)
    assert (60_000, 60_001, 2) in word_runs.runs_of(words)
    assert (120_001, 2995 * 5, 2995) in word_runs.runs_of(words)


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 0
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.documents(spark, SF).collect()]
    got = word_runs.query(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    short = {d for d, t in docs if len(t or "") < 20_000}
    rows = {tuple(r) for r in got.collect()}
    assert len(rows) == len(docs)
    want = {plain_row(*d) for d in docs if d[0] in short}
    assert {r for r in rows if r[0] in short} == want and any(r[1] for r in want)


def test_edges_of_runs(spark, edge_docs, no_docs, tmp_path):  # noqa: F811
    out = word_runs.find_runs(edge_docs).collect()
    assert len(out) == edge_docs.count() and all(r.collapsed is not None for r in out)
    assert word_runs.find_runs(no_docs).count() == 0
    rows = [(1, "a b " * 4), (2, "a " * 6), (3, "a a a a a"), (4, "x a b a b a b a b y"), (5, None),
            (6, ""), (7, " é ß  é ß é ß é ß é ß é ß z"), (None, "q " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1))
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed)
           for r in word_runs.find_runs(docs).collect()}
    assert got[1] == ([(0, 8, 2)], "a b") and got[2] == ([(0, 6, 1)], "a")
    assert got[3] == ([], "a a a a a") and got[4] == ([(1, 8, 2)], "x a b y")
    assert got[5] == got[6] == ([], "") and got[None] == ([(0, 9, 1)], "q")
    assert got[7] == ([(0, 6, 1)], "é ß z")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    assert word_runs.query(spark, folder).count() == len(rows)
