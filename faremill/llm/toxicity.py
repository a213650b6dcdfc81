"""Toxicity by a classifier chain: linear models predict the categories one after the other, and
each gets the probabilities of the categories before it as features.

Categories, in chain order: ``insult`` and ``contempt`` (a toxic label and a word of the category's
list in the text; their models learn from the text like the last), then ``toxic`` (the label).
In training, earlier categories enter as out-of-fold predictions: each comes from a model that did
not see the document's fold (by a hash of its features, so equal texts lie in one), so the later model learns how far real predictions can be trusted.

Features are a text's distinct words and their first 4, 5 and 6 letters, letters only, lower case.
Spark counts them over a bounded hash sample of labelled documents (``max_docs``, toxic ones up to
half), and the ``n_features`` that tell the label best (chi-squared) are used. The threshold is the
one with the best F1 of the out-of-fold predictions (of several, the middle one).

Defined cases: null text or text without letters has probability 0 everywhere and is not toxic;
labels null or other than 0 and 1 are not learned from, and an id labelled both ways counts as
toxic; without both kinds of labels nothing is toxic; repeated rows repeat their result; of an id's several
texts the smallest is learned from; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from faremill.llm import common

#: Fixed word lists of the named categories; words match whole.
CATEGORY_WORDS = {
    "insult": ("clown", "idiot", "loser", "moron", "stupid"),
    "contempt": ("disgusting", "pathetic", "scum", "trash", "worthless"),
}
CHAIN = (*CATEGORY_WORDS, "toxic")
PREFIXES = (4, 5, 6)
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    found = set(words)
    for n in PREFIXES:
        found.update({w[:n] + "*" for w in words if len(w) > n})
    return found


def categories(text: str, toxic: int) -> tuple[int, ...]:
    words = set(_WORD.findall(text.lower()))
    return (*(int(toxic and bool(words & set(listed))) for listed in CATEGORY_WORDS.values()),
            toxic)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class Rows:
    """Sparse binary rows: indices of the features that each document has."""

    def __init__(self, lists: list[list[int]], width: int):
        self.width = width
        self.sizes = np.array([len(x) for x in lists])
        self.index = np.fromiter((i for x in lists for i in x), np.int64, self.sizes.sum())
        self.row = np.repeat(np.arange(len(lists)), self.sizes)

    def take(self, keep: np.ndarray) -> "Rows":
        picked = Rows.__new__(Rows)
        picked.width, picked.sizes = self.width, self.sizes[keep]
        inside = keep[self.row]
        picked.index = self.index[inside]
        picked.row = np.repeat(np.arange(len(picked.sizes)), picked.sizes)
        return picked

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.index], minlength=len(self.sizes))


def fit(rows: Rows, extra: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 0.3,
        penalty: float = 2e-4):
    """Logistic regression by AdaGrad: weights of features, of the extra columns, and the bias."""
    w, v = np.zeros(rows.width), np.zeros(extra.shape[1] + 1)
    dense = np.column_stack([extra, np.ones(len(y))])
    w_seen, v_seen = np.full_like(w, 1e-8), np.full_like(v, 1e-8)
    for _ in range(rounds):
        error = (y - sigmoid(rows.sums(w) + dense @ v)) / len(y)
        up_w = np.bincount(rows.index, error[rows.row], minlength=rows.width) - penalty * w
        up_v = dense.T @ error
        w_seen += up_w ** 2
        v_seen += up_v ** 2
        w += rate * up_w / np.sqrt(w_seen)
        v += rate * up_v / np.sqrt(v_seen)
    return w, v


def predict(model, rows: Rows, extra: np.ndarray) -> np.ndarray:
    w, v = model
    return sigmoid(rows.sums(w) + np.column_stack([extra, np.ones(len(rows.sizes))]) @ v)


def folds(lists: list[list[int]]) -> np.ndarray:
    """Fold of each row by its features, so that no model has seen an equal row of another fold."""
    return np.array([zlib.crc32(np.array(x, "<i8").tobytes()) % FOLDS for x in lists], int)


def fit_chain(lists: list[list[int]], targets: np.ndarray, width: int):
    """One model a category, trained on out-of-fold predictions of the earlier ones, and the
    threshold of the last."""
    rows = Rows(lists, width)
    fold = folds(lists)
    extra = np.zeros((len(lists), 0))
    models = []
    for target in targets.T.astype(float):
        models.append(fit(rows, extra, target))
        held = np.zeros(len(lists))
        for k in range(FOLDS):
            seen = fold != k
            model = fit(rows.take(seen), extra[seen], target[seen])
            held[~seen] = predict(model, rows.take(~seen), extra[~seen])
        extra = np.column_stack([extra, logit(held)])
    truth = targets[:, -1] == 1
    cuts = np.linspace(0.2, 0.8, 25)
    f1 = [2 * (truth & (held >= c)).sum() / max(1, truth.sum() + (held >= c).sum()) for c in cuts]
    best = np.flatnonzero(np.array(f1) == max(f1))
    return models, float(cuts[best[len(best) // 2]])


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", max_docs: int = 6000, n_features: int = 2000):
    """(index of features, models, threshold), or None without labels of both kinds."""
    known = (labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
             .filter("key is not null and label in (0, 1)").groupBy("key")
             .agg(F.max("label").alias("label")))
    counts = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    whole = 1_000_000
    part = F.pmod(F.xxhash64("key"), F.lit(whole))
    share = F.when(F.col("label") == 1, whole * (max_docs // 2) / counts[1]).otherwise(
        whole * (max_docs - min(counts[1], max_docs // 2)) / counts[0])
    chosen = known.filter(part < share).orderBy(part, "key").limit(max_docs)
    rows = common.stored(
        df.filter(F.col(text).isNotNull())
        .select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        .join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text")),
        "toxic-sample")  # one row for each of at most max_docs ids, chosen before the shuffle

    def tallied(batches):
        import pyarrow as pa
        for batch in batches:
            seen = [Counter(), Counter()]
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y].update(features(text))
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()),
                 pa.array([seen[0][f] for f in names], pa.int64())], names=["f", "pos", "neg"])

    n_pos = rows.filter("label = 1").count()
    n_neg = rows.filter("label = 0").count()
    if not n_pos or not n_neg:
        return None
    pos, neg = F.col("pos"), F.col("neg")
    expected = (pos + neg) * F.lit(n_pos / (n_pos + n_neg))
    spread = F.pow(pos - expected, 2) / expected + F.pow(pos - expected, 2) / (
        pos + neg - expected)
    best = (rows.select("text", "label").mapInArrow(tallied, "f string, pos long, neg long")
            .groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
            .filter(pos + neg >= 3).orderBy(F.desc(spread), "f").limit(n_features).collect())
    index = {row.f: i for i, row in enumerate(best)}

    def listed(labels_, texts):
        for y, t in zip(labels_, texts):
            yield (sorted(index[f] for f in features(t) if f in index), list(categories(t, y)))

    sample = common.map_texts(rows.select("label", "text"), listed,
                              "f array<int>, y array<int>").collect()
    sample.sort(key=lambda row: (row.f, row.y))
    models, threshold = fit_chain([row.f for row in sample], np.array([row.y for row in sample]),
                                  len(index))
    return index, models, threshold


def probabilities(model, text: str | None) -> list[float]:
    """Of each category in chain order; each model sees the logits of those before it."""
    found = features(text)
    if model is None or not found:
        return [0.0] * len(CHAIN)
    index, models, _ = model
    at = [index[f] for f in found & index.keys()]
    out: list[float] = []
    for w, v in models:
        score = float(w[at].sum()) + float(v[-1]) + sum(
            float(a) * float(logit(p)) for a, p in zip(v, out))
        out.append(float(sigmoid(score)))
    return out


def score(df: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a probability for each category but the last, toxic_score, toxic) of every row."""
    def rows(keys, texts):
        for k, t in zip(keys, texts):
            p = probabilities(model, t)
            yield (k, *p, model is not None and p[-1] >= model[2])

    kind = df.schema[key].dataType.simpleString()
    named = ", ".join(f"{name}_score double" for name in CHAIN)
    return common.map_texts(df.select(F.col(key), F.col(text).cast("string")), rows,
                            f"key {kind}, {named}, toxic boolean").withColumnRenamed("key", key)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
