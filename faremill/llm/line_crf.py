"""Line quality: a linear-chain conditional random field marks lines as content or boilerplate.

Lines are the pieces between line feeds that hold a word. Each has binary features (length, symbols,
digits, capitals, bars, repetition inside the line and of earlier lines, end of sentence). Weights
of features and of steps between neighbouring lines are fitted by gradient ascent of the likelihood
on a bounded hash sample of labelled documents (``max_docs``; of each, a window of ``max_lines`` lines
at a hashed place of its whole text, whose features know all lines before), with every line
carrying its document's quality label. An id of several rows gives one of them. Viterbi decoding of a whole text gives its most
likely labels, and a text is kept if at least ``MIN_CONTENT`` of its word characters stand in
content lines.

Before that, base rules fail texts of under 20 words and texts in which over 30 % of the words are
in 8-word windows that occur twice or more.

Defined cases: null text is empty: no words, base failed, not kept; a text without lines keeps no content; without labelled rows of both kinds, every line counts as content; texts are read
whole; repeated rows and ids repeat their result; an empty table gives no rows; other columns are
ignored."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from faremill.llm import common

MIN_WORDS, MAX_REPEATED_PERCENT, SPAN = 20, 30, 8
MIN_CONTENT = 0.5
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\r\x0b\x0c"
_BLANK_BYTES = BLANK.encode()
FEATURES = ("bias", "few words", "many words", "symbols", "bars", "digits", "capitals",
            "repeats words", "line seen before", "no sentence end", "exclaims")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of SPAN words that occur at least twice."""
    n = len(words) - SPAN + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for i in range(SPAN):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[i:i + n]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    # equal hashes only propose: windows are compared as sequences
    suspects = np.zeros(n, bool)
    suspects[order[1:][same]] = suspects[order[:-1][same]] = True
    at = np.flatnonzero(suspects)
    windows = ids[at[:, None] + np.arange(SPAN)]
    _, group, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    starts = at[times[group.ravel()] > 1]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + SPAN, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base(text: str) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    lines = 0
    for line in text.split("\n"):
        if line.strip(BLANK):
            lines += 1
            seen.add(line)
    repeated = repeated_words(words)
    n = len(words)
    return (n, len(text) - sum(map(text.count, BLANK)), sum(map(text.count, SYMBOLS)),
            lines - len(seen), repeated,
            n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of features and the word characters of each line that holds a word."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = line.split()
        if not words:
            continue
        size = sum(map(len, words))
        letters = sum(map(line.count, SYMBOLS))
        bars = line.count("|")
        digits = sum(map(line.count, "0123456789"))
        n = len(words)
        rows.append((
            1, n < 3, n > 30, letters > 0.05 * size, bars > 2, digits > 0.2 * size,
            n > 2 and line.isupper(), n > 5 and len(set(words)) < 0.5 * n, line in seen,
            line.rstrip()[-1:] not in ".!?…。", line.count("!") > 0.2 * n))
        sizes.append(size)
        seen.add(line)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(sizes, float)


def _log_sum(a, b):
    high = np.maximum(a, b)
    return high + np.log(np.exp(a - high) + np.exp(b - high))


def fit(docs: list[tuple[np.ndarray, int]], rounds: int = 150, rate: float = 0.3,
        penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (2, features) and steps (2, 2) that make the line labels likely.

    docs: feature rows of the lines and the label of a document. Lines are padded to the longest
    document; forward and backward sums run over all documents at once."""
    weights, steps = np.zeros((2, len(FEATURES))), np.zeros((2, 2))
    if len({label for _, label in docs}) < 2:
        weights[1, 0] = 1.0
        return weights, steps
    longest = max(len(x) for x, _ in docs)
    x = np.zeros((len(docs), longest, len(FEATURES)))
    real = np.zeros((len(docs), longest), bool)
    for i, (lines, _) in enumerate(docs):
        x[i, :len(lines)], real[i, :len(lines)] = lines, True
    labels = np.array([label for _, label in docs])
    share = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    share /= np.maximum(1, real.sum(1)) * len(docs)  # documents count alike, and so do labels
    total = [np.zeros_like(weights), np.zeros_like(steps)]
    for _ in range(rounds):
        scores = x @ weights.T
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, longest):
            moved = np.stack([_log_sum(ahead[:, t - 1, 0] + steps[0, k],
                                       ahead[:, t - 1, 1] + steps[1, k]) for k in (0, 1)], -1)
            ahead[:, t] = np.where(real[:, t, None], moved + scores[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            later = behind[:, t + 1] + scores[:, t + 1]
            moved = np.stack([_log_sum(later[:, 0] + steps[k, 0], later[:, 1] + steps[k, 1])
                              for k in (0, 1)], -1)
            behind[:, t] = np.where(real[:, t + 1, None], moved, 0)
        norm = _log_sum(ahead[:, -1, 0], ahead[:, -1, 1])
        # ahead stops changing after a document's last line, so norm is its sum over labellings
        belief = np.exp(np.minimum(0, ahead + behind - norm[:, None, None])) * real[..., None]
        truth = np.stack([labels == 0, labels == 1], -1)[:, None, :] * real[..., None]
        up = np.einsum("dtk,dtf,d->kf", truth - belief, x, share) - penalty * weights
        pairs = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                joint = np.exp(np.minimum(0, ahead[:, :-1, a] + steps[a, b] + scores[:, 1:, b]
                                          + behind[:, 1:, b] - norm[:, None]))
                known = (labels == a) & (labels == b)
                pairs[a, b] = ((known[:, None] - joint) * real[:, 1:] * share[:, None]).sum()
        for value, gradient, memory in ((weights, up, total[0]),
                                        (steps, pairs - penalty * steps, total[1])):
            memory += gradient ** 2
            value += rate * gradient / (np.sqrt(memory) + 1e-9)
    return weights, steps


def viterbi(scores: np.ndarray, steps: np.ndarray) -> list[int]:
    """The most likely labels (0 boilerplate, 1 content); ties go to content."""
    (s00, s01), (s10, s11) = steps.tolist()
    rows = scores.tolist()
    zero, one = rows[0]
    back = []
    for e0, e1 in rows[1:]:
        to0, to1 = (one + s10 >= zero + s00), (one + s11 >= zero + s01)
        back.append((to0, to1))
        zero, one = ((one + s10 if to0 else zero + s00) + e0,
                     (one + s11 if to1 else zero + s01) + e1)
    labels = [int(one >= zero)]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def content_share(text: str, model) -> float:
    weights, steps = model
    features, sizes = line_features(text)
    if not len(sizes):
        return 0.0
    labels = np.array(viterbi(features @ weights.T, steps))
    return float((labels * sizes).sum() / sizes.sum())


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", max_docs: int = 3000, max_lines: int = 40):
    """Fits the field on at most about ``max_docs`` labelled rows, chosen by hash of the id."""
    known = (labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
             .filter("key is not null and label in (0, 1)").groupBy("key")
             .agg(F.min("label").alias("label")))
    counts = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return fit([])
    half = 1_000_000
    part = F.pmod(F.xxhash64("key"), F.lit(half))
    share = F.when(F.col("label") == 1, half * max_docs // 2 / counts[1]).otherwise(
        half * max_docs // 2 / counts[0])
    chosen = known.filter(part < share).orderBy(part, "key").limit(max_docs)  # bounds the broadcast
    texts = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(chosen), "key")

    def listed(keys, found, labels_):
        for k, text_, y in zip(keys, found, labels_):
            lines = line_features(text_ or "")[0]
            mark = zlib.crc32(f"{k}:{len(lines)}".encode())
            first = mark % max(1, len(lines) - max_lines + 1)
            yield k, lines[first:first + max_lines].ravel().tolist(), y

    # lines may be of any length, so only their features go on; one row an id is collected
    kind = df.schema[key].dataType.simpleString()
    made = (common.map_texts(texts.select("key", "text", "label"), listed,
                             f"key {kind}, x array<double>, label int")
            .groupBy("key").agg(F.min(F.struct("x", "label")).alias("row")).select("row.*").collect())
    made.sort(key=lambda row: (row.x, row.label))
    return fit([(np.array(row.x).reshape(-1, len(FEATURES)), row.label)
                for row in made if row.x])


def judge(df: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    def rows(keys, texts):
        for k, t in zip(keys, texts):
            counts = base(t or "")
            share = content_share(t or "", model)
            yield (k, *counts, not counts[-1] and share >= MIN_CONTENT, share)

    kind = df.schema[key].dataType.simpleString()
    return common.map_texts(
        df.select(F.col(key), F.col(text).cast("string")), rows,
        f"key {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, content_share double"
    ).withColumnRenamed("key", key)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, model)
