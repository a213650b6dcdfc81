"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of a bounded sample of labelled text recognises every substring of
the sample. A text is parsed greedily against it: each phrase is the longest match that starts where
the last phrase ended. The language that needs the fewest phrases per character wins (ties: the
smaller name by code point); the score is 1 - fewest / second fewest. A text that needs many phrases
even in its best language is in none of them: ``accepted`` rejects it.

Text is lower-cased and each run of other characters than letters becomes one space. Every letter of
the samples is a symbol of its own; one that a language's sample lacks never continues a phrase there. The result is parsed in windows of ``WINDOW`` characters, so that numpy walks the
automata over all windows of a batch in step; a phrase ends at its window's end. Every character is
parsed.

Learning takes rows with a remainder other than 2 of crc32(id) mod 4 and a language. Per language,
those texts with the smallest hashes are taken up to ``sample_docs``, a text with many copies once.
Each gives an equal share of ``sample_chars``, from a place in the whole text that its hash draws, or
the whole text if that is shorter. These bounds per language are all that reaches the driver and the
tasks. Hashes are made distinct before they are ranked, so no text is shuffled whole.

Defined cases: null text or text without a letter is ``und`` with score 0, as is every text if there
is nothing to learn from; with one learned language the score is 1; a row with null id is neither
learned from nor held out; repeated rows repeat their result; an empty table gives no rows; other
columns are ignored. Every language is learned, and its sample does not depend on how many others
there are; the more there are, the fewer letters have columns."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from faremill.llm import common

WINDOW = 512
# A language's most common letters have columns in its table, as many as memory allows; its other
# letters are looked up in sorted steps, which is slower and takes less memory.
COLUMNS, TABLE_BYTES = 64, 128 << 20
# Text of a learned language takes 0.1 to 0.45 phrases a character, random letters and other scripts
# 0.7 to 1; a few phrases more are allowed, as short texts tell little.
MAX_RATE, SPARE_PHRASES = 0.6, 8
PAD, OTHER, SPACE = 0, 1, 2
UNKNOWN = "und"


def folded(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of non-letters as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[np.minimum(codes, 0x10FFFF)]
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # the first of a run of others
    keep[:1] = True
    return np.where(letters, codes, 32)[keep]


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def automaton(symbols) -> list[dict[int, int]]:
    """Transitions of the minimal-size suffix automaton of a sequence; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for c in symbols:
        new = len(step)
        step.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if longest[to] == longest[at] + 1:
                link[new] = to
            else:
                clone = len(step)
                step.append(dict(step[to]))
                longest.append(longest[at] + 1)
                link.append(link[to])
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = clone
                    at = link[at]
                link[to] = link[new] = clone
        last = new
    return step


class Table:
    """The automaton of one language over the codes of the letters.

    A cell is twice the next state's row start, plus 1 if the step ends a phrase: the symbol does not
    continue the match, so a new phrase starts with it. Columns are padding, letters that the sample
    lacks, space, common letters, and last the rare letters, whose steps are in ``keys``."""

    def __init__(self, sample: np.ndarray, steps: list[dict[int, int]], symbols: int, columns: int):
        found, counts = np.unique(sample[sample > SPACE], return_counts=True)
        letters = found[np.lexsort((found, -counts))]
        common = letters[:columns - 4]
        self.width = width = 4 + len(common)
        self.rare = width - 1
        self.symbols = symbols
        self.column = np.full(symbols, OTHER, np.uint8)
        self.column[[PAD, SPACE]] = PAD, SPACE
        self.column[letters] = self.rare
        self.column[common] = 3 + np.arange(len(common))
        lost = len(steps)  # after a letter that the sample lacks: a phrase of its own
        start = np.full(symbols, lost, np.int64)
        for c, to in steps[0].items():
            start[c] = to
        self.start = start * width << 1 | 1
        cells = np.empty((lost + 1, width), np.int32)
        cells[:] = self.start[OTHER]
        cells[:, SPACE] = self.start[SPACE]
        cells[:, 3:self.rare] = self.start[common]
        cells[0] &= ~1  # only a window's first symbol leaves the start state
        rare = []
        for state, moves in enumerate(steps):
            for c, to in moves.items():
                at = self.column[c]
                if at == self.rare:
                    rare.append((state * symbols + c, (to * width) << 1))
                else:
                    cells[state, at] = (to * width) << 1
        cells[:, PAD] = np.arange(lost + 1) * width << 1
        self.cells = cells.ravel()
        rare.sort()
        self.keys = np.array([k for k, _ in rare], np.int64)
        self.steps = np.array([to for _, to in rare], np.int32)

    def phrases(self, codes: np.ndarray) -> np.ndarray:
        """Phrases of windows whose codes are the columns."""
        state = np.zeros(codes.shape[1], np.int32)
        ended = np.ones(codes.shape[1], np.int32)  # the phrase that the window's end ends
        for code in codes:
            column = self.column.take(code)
            moved = self.cells.take(state + column)
            if len(self.keys):
                at = np.flatnonzero(column == self.rare)
                if len(at):
                    key = state[at].astype(np.int64) // self.width * self.symbols + code[at]
                    spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                    moved[at] = np.where(self.keys[spot] == key, self.steps[spot],
                                         self.start[code[at]])
            ended += moved & 1
            state = moved >> 1
        return ended


class Model:
    """Codes of the letters of all samples, and a table for each language."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in samples]
        texts = [folded(sample) for _, sample in samples]
        letters = np.setdiff1d(np.concatenate(texts), [32]) if texts else np.empty(0, np.uint32)
        self.codes = np.full(0x110000, OTHER, np.int32)
        self.codes[32] = SPACE
        self.codes[letters] = 3 + np.arange(len(letters))
        states = 2 * sum(map(len, texts)) + 1
        columns = max(4, min(COLUMNS, TABLE_BYTES // (4 * states)))
        self.tables = []
        for text in texts:
            coded = self.codes[text]
            self.tables.append(Table(coded, automaton(coded.tolist()), 3 + len(letters), columns))

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text against each language: (texts, languages)."""
        coded = [self.codes[folded(t)] for t in texts]
        windows = np.array([max(1, math.ceil(len(c) / WINDOW)) for c in coded])
        padded = np.full((windows.sum(), WINDOW), PAD, np.int32)
        first = np.concatenate([[0], np.cumsum(windows)])
        flat = padded.ravel()
        for c, at in zip(coded, first):
            flat[at * WINDOW:at * WINDOW + len(c)] = c
        columns = np.ascontiguousarray(padded.T)
        made = np.empty((len(padded), len(self.tables)), np.int32)
        for language, table in enumerate(self.tables):
            made[:, language] = table.phrases(columns)
        return np.add.reduceat(made, first[:-1], axis=0)


@lru_cache(1)  # a task works with one model; more would stay in the worker
def model_of(samples: tuple[tuple[str, str], ...]) -> Model:
    return Model(samples)


def classify(samples, texts: list[str]) -> list[tuple[str, float, int]]:
    """(language, score, fewest phrases) of texts that have a letter."""
    out: list[tuple[str, float, int]] = []
    if not samples or not texts:
        return out
    model = model_of(samples)
    size, start = 0, 0
    for i, text in enumerate(texts):  # batches of bounded size, long texts on their own
        size += len(text)
        if size >= 1 << 21 or i == len(texts) - 1:
            for counts in model.phrases(texts[start:i + 1]).tolist():
                order = sorted(range(len(counts)), key=lambda k: (counts[k], model.names[k]))
                score = 1.0 if len(order) < 2 else 1 - counts[order[0]] / counts[order[1]]
                out.append((model.names[order[0]], score, counts[order[0]]))
            size, start = 0, i + 1
    return out


def remainder(key):
    return F.crc32(F.col(key).cast("string")) % 4


def learn(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          sample_docs: int = 200, sample_chars: int = 24_000) -> tuple[tuple[str, str], ...]:
    """(language, sample) of every language, by name."""
    known = df.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")
                      & (remainder(key) != 2))
    known = known.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("h"),
                         F.col(text).alias("body"))
    texts = common.stored(known.select("lang", "h").distinct(), "language-texts")
    sizes = common.stored(texts.groupBy("lang").agg(F.count("*").alias("texts")), "language-sizes")
    # hashes are uniform, so those below twice the wanted share hold the smallest, and few others
    place = F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63))
    best = Window.partitionBy("lang").orderBy("place", "h")
    chosen = common.stored(texts.withColumn("place", place).join(common.small_side(sizes), "lang")
              .filter(F.col("place") < 2.0 * sample_docs / F.col("texts"))
              .withColumn("at", F.row_number().over(best)).filter(F.col("at") <= sample_docs)
              .select("lang", "h", "at", F.floor(sample_chars / F.least("texts", F.lit(sample_docs)))
                      .cast("int").alias("share")), "language-chosen")
    places = F.greatest(F.length("body") - F.col("share") + 1, F.lit(1))
    piece = F.substring(F.col("body"), (F.pmod(F.xxhash64("h"), places) + 1).cast("int"),
                        F.col("share"))
    rows = (known.join(common.small_side(chosen), ["lang", "h"])
            .select("lang", "at", piece.alias("sample"))
            .groupBy("lang", "at").agg(F.min("sample").alias("sample")))
    samples: dict[str, list[str]] = {}
    for row in rows.orderBy("lang", "at").collect():
        samples.setdefault(row.lang, []).append(row["sample"])
    return tuple((name, "\n".join(dict.fromkeys(texts))[:sample_chars])
                 for name, texts in sorted(samples.items()))


def predict(df: DataFrame, samples, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score) of every row."""
    def rows(keys, held, texts):
        usable = [t for t in texts if samples and has_letter(t)]
        found = iter(classify(samples, usable))
        for k, out, t in zip(keys, held, texts):
            yield (k, out, *(next(found)[:2] if samples and has_letter(t) else (UNKNOWN, 0.0)))

    kind = df.schema[key].dataType.simpleString()
    held = F.coalesce(remainder(key) == 2, F.lit(False))
    return common.map_texts(
        df.select(F.col(key), held, F.col(text).cast("string")), rows,
        f"key {kind}, held_out boolean, lang_pred string, score double"
    ).withColumnRenamed("key", key)


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             **sample) -> DataFrame:
    return predict(df, learn(df, key, text, lang, **sample), key, text)


def accepted(df: DataFrame, samples, text: str = "text", max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of ``df`` whose text is in a learned language: its best parse has at most
    ``max_rate`` phrases a character, and SPARE_PHRASES more."""
    @F.pandas_udf("boolean")
    def good(texts):
        usable = [t for t in texts if samples and has_letter(t)]
        parsed = iter(phrases <= max_rate * len(folded(t)) + SPARE_PHRASES
                      for t, (_, _, phrases) in zip(usable, classify(samples, usable)))
        return texts.map(lambda t: bool(samples) and has_letter(t) and next(parsed))

    return common.bounded_batches(df).filter(good(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    return identify(common.documents(spark, sf_dir))
