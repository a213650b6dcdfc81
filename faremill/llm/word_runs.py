"""Periodic runs of words: stretches that repeat a piece of text four times or more.

A run is a maximal stretch with smallest period q, at least ``least`` words long and at least
``times`` periods. Every run holds a Lyndon root, a conjugate of its period that is smaller than
all its suffixes in one of two opposite orders of words, and there the root is the longest Lyndon
word. So the two Lyndon arrays name every period and a place in its run.

1. Grouping, the first phase of a suffix sorter, gives a Lyndon array. Suffixes start in groups by
   their first word. Groups are taken from the highest down; each suffix of a group points to the
   nearest place before it in a lower group, and the suffixes pointed to move up into new groups
   right above their own, whose context grows by the group's context once per pointer. When a
   group is taken, its context is the longest Lyndon word of its suffixes. The opposite order runs
   the same with the words' order turned round.
2. A place whose root is followed by two more equal copies (compared by hashes first) is extended
   by longest common extension to both sides, word by word exactly. Places in a known run of that
   period are passed over.

A run's three-word pieces all occur three times or more in its document, so words that are in no
such piece are left out before; the rest is cut into segments that hold the runs whole. No length
is bounded; a document is the unit of work, and nothing is shuffled.

Defined cases: null text has no words; an empty table gives no rows; rows are independent, so null
and repeated ids are safe; other columns are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from faremill.llm import common

LEAST, TIMES = 6, 4
_MIX = np.random.default_rng(11).integers(0, 1 << 63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place."""
    n = len(symbols)
    starts: dict[int, list[int]] = {}
    for i, s in enumerate(symbols):
        starts.setdefault(s, []).append(i)
    # groups from low to high as a linked list; id 0 is the floor
    members: list[list[int]] = [[]]
    context, below, above = [0], [0], [0]
    group = [0] * n
    top = 0
    for s in sorted(starts):
        g = len(members)
        members.append(starts[s])
        context.append(1)
        below.append(top)
        above.append(0)
        above[top] = g
        top = g
        for i in starts[s]:
            group[i] = g
    lengths = [0] * n
    lower = [-1] * n  # nearest place before, in a lower group
    done = bytearray(n)
    now = top
    while now:
        size = context[now]
        pointed: dict[int, int] = {}
        for i in members[now]:
            if group[i] != now:  # moved up and taken already
                continue
            j = i - 1
            hops = 0
            while j >= 0 and done[j]:
                j = lower[j]
                hops += 1
            if hops > 2:  # later walks skip what was walked
                k = i - 1
                while k >= 0 and done[k]:
                    lower[k], k = j, lower[k]
            lower[i] = j
            lengths[i] = size
            done[i] = 1
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            counts = sorted(set(pointed.values()), reverse=True)
            for count in counts:
                moved: dict[int, int] = {}  # old group, new group right above it
                for j, c in pointed.items():
                    if c != count:
                        continue
                    old = group[j]
                    new = moved.get(old)
                    if new is None:
                        new = moved[old] = len(members)
                        members.append([])
                        context.append(context[old] + count * size)
                        below.append(old)
                        over = above[old]
                        above.append(over)
                        above[old] = new
                        below[over] = new
                    members[new].append(j)
                    group[j] = new
        now = below[now]
    return lengths


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common prefix of two arrays."""
    most, at, width = min(len(a), len(b)), 0, 64
    while at < most:
        stop = min(at + width, most)
        differ = np.flatnonzero(a[at:stop] != b[at:stop])
        if len(differ):
            return at + int(differ[0])
        at, width = stop, width * 4
    return most


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of word numbers, by start, then period."""
    n = len(words)
    if n < max(least, times):
        return []
    symbols = words.tolist()
    periods = np.array([lyndon_lengths(symbols), lyndon_lengths([-s for s in symbols])])
    power = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.full(n, _MIX[3]), out=power[1:])
    # prefix sums of words times powers; two pieces agree where the sums do, shifted by powers
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((words.astype(np.uint64) + np.uint64(1)) * _MIX[0] * power[:n], out=sums[1:])
    copies = times - 1  # a run's first root starts in its first period
    found: dict[int, list[tuple[int, int]]] = {}
    for q_all in periods:
        i = np.flatnonzero(np.arange(n) + copies * q_all <= n)
        q = q_all[i]
        end = i + (copies - 1) * q
        alike = (sums[end] - sums[i]) * power[q] == sums[end + q] - sums[i + q]
        for at, period in zip(i[alike].tolist(), q[alike].tolist()):
            known = found.setdefault(period, [])
            if known and known[-1][0] <= at and at + period <= known[-1][1]:
                continue
            right = _common(words[at:n - period], words[at + period:])
            left = _common(words[:at][::-1], words[:at + period][::-1])
            known.append((at - left, at + period + right))
    return sorted({(a, b - a, q) for q, places in found.items() for a, b in places
                   if b - a >= max(least, times * q)})


def segments(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a batch of documents (borders in ``bounds``) that may hold runs: every piece of
    three words in them occurs three times or more in its document."""
    n = len(ids)
    if n < LEAST:
        return []
    document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = np.flatnonzero(document[:-2] == document[2:])
    x = ids.astype(np.uint64)
    key = (x[:-2] * _MIX[0] + x[1:-1]) * _MIX[1] + x[2:]
    key = ((key + document[:-2].astype(np.uint64) * _MIX[2]) * _MIX[3])[whole]
    order = np.argsort(key)
    ordered = key[order]
    edge = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1], True])
    often = np.repeat(np.diff(edge) >= 3, np.diff(edge))
    at = np.sort(whole[order[often]])
    if not len(at):
        return []
    split = np.flatnonzero((np.diff(at) > 1) | (document[at[1:]] != document[at[:-1]])) + 1
    first, last = at[np.r_[0, split]], at[np.r_[split - 1, len(at) - 1]] + 3
    long_enough = last - first >= LEAST
    return list(zip(first[long_enough].tolist(), last[long_enough].tolist()))


def batch_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of every document of a batch, given as lists of words."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, last in segments(ids, bounds):
        where = int(np.searchsorted(bounds, first, "right")) - 1
        shift = first - int(bounds[where])
        out[where] += [(a + shift, length, q) for a, length, q in runs_of(ids[first:last])]
    return [sorted(r) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    drop = bytearray(len(words))
    for start, length, q in runs:
        drop[start + q:start + length] = b"\1" * (length - q)
    return b" ".join(w for w, gone in zip(words, drop) if not gone)


def find_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, runs, collapsed) of every row: runs as (start, length, period) by start, then period,
    in words from 0, and the text with every run cut to its first period."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    fields = pa.schema([("key", to_arrow_type(df.schema[key].dataType)), ("runs", pa.list_(run)),
                        ("collapsed", pa.string())])

    def find(batches):
        for batch in batches:
            texts = [(t or b"").split() for t in batch.column(1).to_pylist()]
            runs = batch_runs(texts)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(fields[0].type),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in some]
                          for some in runs], fields[1].type),
                pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(
                    pa.string())], schema=fields)

    kind = df.schema[key].dataType.simpleString()
    return common.bounded_batches(df).select(
        F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("body")).mapInArrow(
        find, f"key {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
              "collapsed string").withColumnRenamed("key", key)


def altered(doc_id: int | None, text: str | None) -> str | None:
    """The stated periodic tail of every tenth document; a null id alters nothing."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    words = (text or "").encode().split() if h % 10 == 0 else []
    if not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()


def query(spark, sf_dir: str) -> DataFrame:
    documents = common.map_texts(
        common.documents(spark, sf_dir).select("doc_id", "text"),
        lambda ids, texts: ((i, altered(i, t)) for i, t in zip(ids, texts)),
        "doc_id long, text string")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return find_runs(documents).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
