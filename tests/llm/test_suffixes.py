"""Removal of repeated byte strings against brute force over all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from text_rows import edge_docs, no_docs  # noqa: F401
from faremill.llm import common, suffix_dedup


def plain_cut(bodies, width):
    """(removed runs, kept) of every text."""
    seen = Counter(b[i:i + width] for b in bodies for i in range(len(b) - width + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        runs, i = [], 0
        while i < len(b):
            j = i
            while j < len(b) and gone[j]:
                j += 1
            if j > i:
                runs.append((i, j - i))
            i = max(j, i + 1)
        out.append((runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def built(draw, texts=40):
    parts = [bytes(draw.choice(b"abcd ") for _ in range(draw.randint(1, 120))) for _ in range(8)]
    out = []
    for _ in range(texts):
        body = b""
        for _ in range(draw.randint(0, 6)):
            if draw.random() < .5:
                body += draw.choice(parts)
            else:
                body += bytes(draw.choice(b"abcdefgh ") for _ in range(draw.randint(1, 90)))
            if draw.random() < .1:
                body += bytes([draw.choice(b"ab")]) * draw.randint(1, 150)
            if draw.random() < .1:
                body += draw.choice([b"ab", b"abc", b"abcde fgh"]) * draw.randint(1, 30)
        out.append(body)
    return out + [out[0], out[1][:-1], b"", b"x" * 39, b"x" * 39, b"y" * 40, b"y" * 40]


def test_pieces_hold_every_string_once_and_anchors_depend_on_content():
    draw, width = random.Random(1), 40
    bodies = built(draw)
    seen, names = Counter(), {}
    for found in suffix_dedup.pieces_of(bodies, width):
        for n, start, count, lead, key in zip(*(a.tolist() for a in found)):
            assert 0 <= lead <= width - suffix_dedup.GRAM
            for i in range(count):
                seen[n, start + i] += 1
                name = names.setdefault(bodies[n][start + i:start + i + width], (key, lead - i))
                assert name == (key, lead - i)
    assert seen == Counter((n, i) for n, b in enumerate(bodies) for i in range(len(b) - width + 1))


def test_blocks_of_long_texts_agree(monkeypatch):
    body = bytes(random.Random(2).choices(b"abc", k=3000))

    def keys():
        return [k for found in suffix_dedup.pieces_of([body], 40)
                for *_, count, lead, key in [tuple(r) for r in zip(*(a.tolist() for a in found))]
                for k in [(key, lead - i) for i in range(count)]]

    whole = keys()
    monkeypatch.setattr(suffix_dedup, "BLOCK", 100)
    assert keys() == whole


def test_rounds_give_suffix_order_and_common_prefixes():
    """The rounds' column of the transform, order and common prefixes against sorted suffixes."""
    draw = random.Random(3)
    for _ in range(100):
        m, length = draw.randint(1, 12), draw.randint(1, 15)
        rows = [[draw.randint(1, 2) for _ in range(length)] for _ in range(m)]
        group = np.array(sorted(draw.randint(0, 2) for _ in range(m)), np.uint16)
        order, prefix = np.arange(m), np.zeros(m, np.uint8)
        for column in range(length - 1, -1, -1):
            symbols = np.array([rows[d][column] for d in order], np.uint16)
            order, prefix = suffix_dedup.insert_column(symbols, group, order, prefix)
            want = sorted(range(m), key=lambda d: (group[d], rows[d][column:]))
            assert [rows[d][column:] for d in order] == [rows[d][column:] for d in want]
            for k in range(1, m):
                a, b = order[k - 1], order[k]
                n = 0
                while (group[a] == group[b] and column + n < length
                       and rows[a][column + n] == rows[b][column + n]):
                    n += 1
                assert prefix[k] == n


@pytest.mark.parametrize("seed,hot", [(4, 100_000), (5, 1), (6, 0)])
def test_cuts_against_all_strings(spark, seed, hot):
    bodies = [b.decode() for b in built(random.Random(seed))]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: ([tuple(s) for s in r.spans], bytes(r.kept), r.n_bytes)
           for r in suffix_dedup.deduplicated(docs, width=40, hot_pieces=hot).collect()}
    want = plain_cut([b.encode() for b in bodies], 40)
    assert {k: v[:2] for k, v in got.items()} == dict(enumerate(want))
    assert all(got[i][2] == len(b) for i, b in enumerate(bodies))
    assert sum(len(r) for r, _ in want) > 20


def test_query_against_all_strings(spark):
    docs = [(r.doc_id, r.text) for r in common.documents(spark, SF).collect()]
    bodies = [(t or "").encode() for _, t in docs]
    cuts = plain_cut(bodies, 200)
    want = {(d, len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
            for (d, _), b, (runs, kept) in zip(docs, bodies, cuts)}
    got = suffix_dedup.query(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(docs) and set(rows) == want and any(r[2] for r in rows)


def test_edges_of_cuts(spark, edge_docs, no_docs, tmp_path):  # noqa: F811
    assert suffix_dedup.deduplicated(no_docs).count() == 0
    out = suffix_dedup.deduplicated(edge_docs.withColumn("a.b", F.lit(1))).collect()
    texts = [r.text for r in edge_docs.select("text").collect()]
    cuts = plain_cut([(t or "").encode() for t in texts], 200)
    assert len(out) == len(texts)
    assert sorted(bytes(r.kept) for r in out) == sorted(kept for _, kept in cuts)
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert suffix_dedup.query(spark, str(tmp_path)).count() == 0
