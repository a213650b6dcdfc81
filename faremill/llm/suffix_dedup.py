"""Removal of byte strings that the collection repeats, by column-wise suffix ordering.

A byte goes if a string of ``width`` bytes that covers it also starts anywhere else, in the same
text or another one; strings are judged on the input.

1. Every such string is named by its smallest hash of 16 bytes (leftmost, if it occurs twice), its
   anchor; equal strings have equal anchors at equal distance. Neighbouring strings with one anchor
   make a piece. Pieces whose anchor's hash occurs once hold nothing repeated and go no further.
2. Equal pieces are counted by a digest before anything large moves, however many copies there are,
   and one place of each is chosen. If an anchor has several different pieces, their bytes meet in
   one task; they are the documents of a collection, aligned at the anchor.
3. The collection's suffix order is built column by column from the right: each round inserts one
   symbol in front of every document. The round's column of the Burrows-Wheeler transform, which is
   the inserted symbols in the order of the suffixes behind them, gives the new order by a stable
   distribution over its symbols, and the common prefixes of neighbours follow from the minimum of
   the old ones between them. Aligned suffixes can only match in their own column, so a round keeps
   its own column of the transform and need not merge it into those before. Symbols lie in a file,
   column after column, and are read once in order; a task holds some bytes per document for order
   and common prefixes. A string is repeated if it shares ``width`` symbols with a neighbour, or if
   its piece occurs twice.
4. Marked strings are joined to the places of their pieces and cut out of the texts.

Pieces of an anchor with very many different ones (a passage that stands in much of the corpus) are
cut into pieces of up to 16 strings, named by the bytes that all of these have in common, so that
one anchor does not gather in one task. Two bitmaps, sized from the number of members up to 32 MB,
tell tasks which anchors may be shared and which texts take part; beyond that size more rows take
the shuffled way, with equal results.

Defined cases: null text is empty; texts shorter than ``width`` stay whole; texts of more than one
row lose all strings of ``width`` bytes, thus everything; rows with null or repeated ids are all
kept and answered; an empty table gives no rows; other columns are ignored. Bytes are cut without
regard to characters, so what is kept is binary."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from faremill.llm import common

WIDTH, GRAM, HOT_STARTS = 200, 16, 16
BLOCK = 1 << 21  # starts looked at together
MOST_BITS = 28
_SEEDS = np.random.default_rng(13)
_GEAR = _SEEDS.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = int(_SEEDS.integers(0, 1 << 62)) * 4 + 1
_MASK = (1 << 64) - 1
_PLACE = np.uint64((1 << 24) - 1)


# ---- pieces and their anchors -------------------------------------------------------------------

def _gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from every place (of fewer near the end)."""
    h, span = _GEAR[buffer], 1
    while span < GRAM:
        tail = h[span:].copy()
        h *= np.uint64(pow(_MULT, span, 1 << 64))
        h[:len(tail)] += tail
        span *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from every place (of fewer near the end)."""
    out, span = values.copy(), 1
    while span < width:
        shift = min(span, width - span)
        np.minimum(out[:-shift], out[shift:], out=out[:-shift])
        span += shift
    return out


def _block_pieces(texts: list[tuple[int, int, bytes]], width: int):
    """Pieces of some stretches (number, offset, bytes): arrays number, start, strings, anchor's
    distance, anchor's hash."""
    sizes = np.array([len(t) for _, _, t in texts])
    buffer = np.frombuffer(b"".join(t for _, _, t in texts), np.uint8)
    if len(buffer) < width:
        return None
    hashes = _gram_hashes(buffer)
    place = np.arange(len(buffer), dtype=np.uint64)
    least = _window_min((hashes & ~_PLACE) | place, width - GRAM + 1)
    ends = np.cumsum(sizes)
    inside = np.ones(len(buffer), bool)
    for begin, end in zip((ends - sizes).tolist(), ends.tolist()):
        inside[max(begin, end - width + 1):end] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return None
    anchor = (least[starts] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(starts) > 1)])
    first = starts[new]
    count = np.diff(np.r_[new, len(starts)])
    text = np.searchsorted(ends, first, "right")
    numbers = np.array([n for n, _, _ in texts])[text]
    offsets = np.array([o for _, o, _ in texts])[text] - (ends - sizes)[text]
    at = anchor[new]
    return numbers, first + offsets, count, at - first, hashes[at].view(np.int64)


def pieces_of(bodies: list[bytes], width: int = WIDTH):
    """Pieces of some texts, as arrays (text number, first start, strings, anchor's distance,
    anchor's hash), in blocks of bounded size. Together they hold every string once."""
    block, size = [], 0
    for number, body in enumerate(bodies):
        for at in range(0, max(len(body) - width + 1, 0), BLOCK):
            part = body[at:at + BLOCK + width - 1]
            if size + len(part) > 2 * BLOCK:
                yield _block_pieces(block, width)
                block, size = [], 0
            block.append((number, at, part))
            size += len(part)
    if block:
        yield _block_pieces(block, width)


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _split_hot(body: bytes, start: int, count: int, lead: int, key: int, width: int):
    """Pieces of up to HOT_STARTS strings of a piece, each with the hash of the bytes that all
    strings between two borders share."""
    anchor = start + lead
    at = start
    while at < start + count:
        number = (at - anchor) // HOT_STARTS
        border = anchor + (number + 1) * HOT_STARTS  # first start of the next piece
        stop = min(border, start + count)
        shared = body[border - 1:border - HOT_STARTS + width]
        name = xxhash.xxh3_64_intdigest(shared, seed=(key + number) & _MASK)
        yield at, stop - at, anchor - at, _signed(name)
        at = stop


class Members:
    """A set of longs as a bitmap with false hits, built by Spark and broadcast."""

    def __init__(self, hashed: DataFrame, count: int):
        self.bits = min(max(20, (8 * count).bit_length()), MOST_BITS)
        bits, low = self.bits, 20
        # low bits: the high ones of an anchor are small, as it is a smallest hash
        slots = hashed.select(F.col(hashed.columns[0]).bitwiseAND(F.lit((1 << bits) - 1))
                              .alias("slot"))

        def packed(batches):
            now, some = None, None
            for batch in batches:
                slots = np.asarray(batch.column(0), np.int64)
                for chunk in np.unique(slots >> low).tolist():
                    if chunk != now:
                        if now is not None:
                            yield row(now, some)
                        now, some = chunk, np.zeros(1 << low, bool)
                    some[slots[slots >> low == chunk] & ((1 << low) - 1)] = True
            if now is not None:
                yield row(now, some)

        def row(chunk, some):
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([np.packbits(some).tobytes()])],
                names=["chunk", "body"])

        chunks = (slots.repartition(F.shiftright("slot", low))
                  .sortWithinPartitions("slot").mapInArrow(packed, "chunk long, body binary"))
        whole = np.zeros(1 << (bits - 3), np.uint8)
        for found in chunks.collect():  # at most 2^(MOST_BITS - 20) rows of 128 KB
            part = np.frombuffer(found.body, np.uint8)
            whole[found.chunk * len(part):(found.chunk + 1) * len(part)] = part
        self.sent = hashed.sparkSession.sparkContext.broadcast(whole)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & ((1 << self.bits) - 1)
        return (self.sent.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def anchor_counts(texts: DataFrame, width: int) -> DataFrame:
    """(key) of the anchors that occur more than once."""
    def keys(batches):
        for batch in batches:
            for found in pieces_of(batch.column(0).to_pylist(), width):
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(found[4])], names=["key"])

    return (texts.select("body").mapInArrow(keys, "key long")
            .groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"))


PLACES = "print binary, start int, strings int, lead int, key long, digest long"


def piece_places(texts: DataFrame, shared: Members, width: int, hot=None) -> DataFrame:
    """PLACES of pieces whose anchor may be shared; with ``hot`` (a broadcast sorted array) only
    pieces of those anchors, cut small."""
    def places(batches):
        for batch in batches:
            prints, bodies = batch.column(0), batch.column(1).to_pylist()
            for found in pieces_of(bodies, width):
                if found is None:
                    continue
                number, start, strings, lead, key = found
                if hot is None:
                    keep = shared.may_hold(key)
                else:
                    at = np.minimum(np.searchsorted(hot.value, key), len(hot.value) - 1)
                    keep = hot.value[at] == key
                rows = list(zip(*(a[keep].tolist() for a in (number, start, strings, lead, key))))
                if hot is not None:
                    rows = [(n, *part) for n, s, c, d, k in rows
                            for part in _split_hot(bodies[n], s, c, d, k, width)]
                if not rows:
                    continue
                digests = [_signed(xxhash.xxh3_64_intdigest(bodies[n][s:s + c + width - 1], seed=d))
                           for n, s, c, d, _ in rows]
                number, start, strings, lead, key = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [prints.take(pa.array(number)), pa.array(start, pa.int32()),
                     pa.array(strings, pa.int32()), pa.array(lead, pa.int32()),
                     pa.array(key, pa.int64()), pa.array(digests, pa.int64())],
                    names=["print", "start", "strings", "lead", "key", "digest"])

    return texts.select("print", "body").mapInArrow(places, PLACES)


def piece_kinds(places: DataFrame) -> DataFrame:
    """Different pieces with their copies and one place each."""
    return places.groupBy("key", "digest", "strings", "lead").agg(
        F.count("*").alias("copies"), F.min(F.struct("print", "start")).alias("place"))


# ---- column-wise construction -------------------------------------------------------------------

class Collection:
    """Documents aligned at an anchor, in groups; symbols go to a file, one block of documents after
    another, column after column in each."""

    def __init__(self, width: int, block: int = 4096):
        self.width, self.block = width, block
        self.left = width - GRAM  # columns before the anchor
        self.columns = self.left + width
        self.groups: list[int] = []
        self.leads: list[int] = []
        self.sizes: list[int] = []
        self.bodies: list[bytes] = []
        self.names: list[tuple] = []
        self.file = tempfile.TemporaryFile()  # this task's own, like a spill
        self.blocks = 0

    def add(self, group: int, name: tuple, lead: int, body: bytes) -> None:
        self.groups.append(group)
        self.names.append(name)
        self.leads.append(lead)
        self.sizes.append(len(body))
        self.bodies.append(body)
        if len(self.bodies) == self.block:
            self._write()

    def _write(self) -> None:
        table = np.zeros((self.block, self.columns), np.uint8)
        at = len(self.sizes) - len(self.bodies)
        for row, body in enumerate(self.bodies):
            begin = self.left - self.leads[at + row]
            table[row, begin:begin + len(body)] = np.frombuffer(body, np.uint8)
        np.ascontiguousarray(table.T).tofile(self.file)
        self.bodies, self.blocks = [], self.blocks + 1

    def _column(self, column: int) -> np.ndarray:
        size = self.block * self.columns
        out = np.empty(self.blocks * self.block, np.uint8)
        for b in range(self.blocks):
            self.file.seek(b * size + column * self.block)
            out[b * self.block:(b + 1) * self.block] = np.frombuffer(
                self.file.read(self.block), np.uint8)
        return out[:len(self.sizes)]

    def repeated(self):
        """(document, first start, last start + 1) of the strings that another document shares."""
        if self.bodies:
            self._write()
        self.file.flush()
        n = len(self.sizes)
        lead, size = np.array(self.leads, np.int32), np.array(self.sizes, np.int32)
        begin = self.left - lead
        end = begin + size
        group = np.unique(np.array(self.groups), return_inverse=True)[1].reshape(-1)
        group = group.astype(np.uint16 if n <= 1 << 16 else np.uint32)
        order = np.arange(n)
        common_prefix = np.zeros(n, np.uint8)
        marked = np.zeros(n, bool)
        opened = np.zeros(n, np.int32)  # columns go down: a run of starts opens at its end
        out = []
        for column in range(self.columns - 1, -1, -1):
            present = (begin <= column) & (column < end)
            if not present.any():
                continue
            symbols = np.where(present, self._column(column).astype(np.uint16) + 1, 0)[order]
            order, common_prefix = insert_column(symbols.astype(np.uint16), group, order,
                                                 common_prefix)
            if column > self.left:
                continue
            near = np.flatnonzero(common_prefix >= self.width)
            hit = np.zeros(n, bool)
            hit[order[near]] = True
            hit[order[near - 1]] = True
            fresh = np.flatnonzero(hit & ~marked)
            opened[fresh] = column + 1
            closed = np.flatnonzero(marked & ~hit)
            out += [(d, max(column + 1 - begin[d], 0), opened[d] - begin[d])
                    for d in closed.tolist()]
            marked = hit
        out += [(d, 0, opened[d] - begin[d]) for d in np.flatnonzero(marked).tolist()]
        self.file.close()
        return out


def insert_column(symbols: np.ndarray, group: np.ndarray, order: np.ndarray, prefix: np.ndarray):
    """Inserts one symbol in front of every document.

    ``symbols`` is the round's column of the transform: the new symbols (0: none) in the order of
    the suffixes they precede; ``group`` is ascending and the same in every order. Returns the new
    order and the common prefixes of neighbours (up to 255)."""
    moved = np.argsort(symbols, kind="stable")
    moved = moved[np.argsort(group[moved], kind="stable")]
    n = len(moved)
    new = np.zeros(n, np.uint8)
    a, b = moved[:-1], moved[1:]
    alike = np.flatnonzero((symbols[a] == symbols[b]) & (symbols[a] > 0) & (group[a] == group[b]))
    if len(alike):
        low, high = a[alike] + 1, b[alike]
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        tables = [prefix]
        for k in range(int(level.max())):
            last = tables[-1]
            wider = last.copy()
            np.minimum(last[:-(1 << k)], last[1 << k:], out=wider[:-(1 << k)])
            tables.append(wider)
        least = np.empty(len(alike), np.uint8)
        for k, table in enumerate(tables):
            at = np.flatnonzero(level == k)
            least[at] = np.minimum(table[low[at]], table[high[at] + 1 - (1 << k)])
        new[alike + 1] = np.minimum(least, 254) + 1
    return order[moved], new


def shared_strings(contexts: DataFrame, width: int, batch_documents: int = 1 << 15) -> DataFrame:
    """(key, digest, low, high): starts of a piece that another piece of its anchor shares."""
    fields = [("key", pa.int64()), ("digest", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]

    def ordered(batches):
        some, groups, last = Collection(width), 0, None
        for batch in batches:
            for key, digest, lead, body in zip(*(c.to_pylist() for c in batch.columns)):
                if last is not None and key != last[0]:
                    groups += 1
                    if len(some.sizes) >= batch_documents:
                        yield marks(some)
                        some, groups = Collection(width), 0
                last = (key, digest)
                some.add(groups, last, lead, body)
        if some.sizes:
            yield marks(some)

    def marks(some):
        found = some.repeated()
        rows = [(*some.names[d], low, high) for d, low, high in found]
        columns = list(zip(*rows)) if rows else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

    return (contexts.repartition("key").sortWithinPartitions("key", "digest")
            .mapInArrow(ordered, "key long, digest long, low int, high int"))


def piece_bodies(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(key, digest, lead, body) of the wanted pieces (print, start, strings, lead, key, digest)."""
    listed = wanted.groupBy("print").agg(F.collect_list(
        F.struct("start", "strings", "lead", "key", "digest")).alias("pieces"))
    prints = common.stored(listed.select(F.xxhash64("print").alias("h"), "print", "pieces"),
                           "suffix-wanted")
    members = Members(prints.select("h"), prints.count())

    def cut(batches):
        fields = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("lead", pa.int32()),
                            ("body", pa.binary())])
        for batch in batches:
            made, size = [], 0
            for body, pieces in zip(*(c.to_pylist() for c in batch.columns)):
                for p in pieces:
                    made.append((p["key"], p["digest"], p["lead"],
                                 body[p["start"]:p["start"] + p["strings"] + width - 1]))
                    size += len(made[-1][3])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*made), fields)], schema=fields)
                    made, size = [], 0
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*made), fields)], schema=fields)

    return (one_each(of_members(texts, members)).join(prints.drop("h"), "print")
            .select("body", "pieces")
            .mapInArrow(cut, "key long, digest long, lead int, body binary"))


def of_members(texts: DataFrame, members: Members) -> DataFrame:
    """(print, body) of the texts that may be members."""
    def some(batches):
        for batch in batches:
            keep = members.may_hold(np.asarray(batch.column(0), np.int64))
            yield batch.filter(pa.array(keep)).select(["print", "body"])

    return texts.select("h", "print", "body").mapInArrow(some, "print binary, body binary")


def one_each(texts: DataFrame) -> DataFrame:
    """One row per text; copies in a task are merged before the shuffle."""
    return texts.groupBy("print").agg(F.first("body").alias("body"))


# ---- the whole ----------------------------------------------------------------------------------

def repeated_spans(texts: DataFrame, width: int = WIDTH, hot_pieces: int = 100_000) -> DataFrame:
    """(print, low, high): starts of repeated strings of every text, from (h, print, body)."""
    shared = common.stored(anchor_counts(texts, width), "suffix-anchors")
    members = Members(shared.select("key"), shared.count())
    places = common.stored(piece_places(texts, members, width), "suffix-places")
    kinds = common.stored(piece_kinds(places), "suffix-kinds")
    keys = common.stored(kinds.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1"),
                         "suffix-keys")
    # a limit that grows with the corpus, so the list of hot anchors does not
    limit = max(hot_pieces, kinds.count() // 20_000)
    hot = keys.filter(F.col("kinds") > limit).select("key")
    names = sorted(r.key for r in hot.collect())
    if names:
        sent = texts.sparkSession.sparkContext.broadcast(np.array(names, np.int64))
        small = piece_places(texts, members, width, sent)
        places = common.stored(places.join(F.broadcast(hot), "key", "left_anti")
                               .select(*small.columns).unionAll(small), "suffix-places")
        kinds = common.stored(piece_kinds(places), "suffix-kinds")
        keys = common.stored(kinds.groupBy("key").agg(F.count("*").alias("kinds"))
                             .filter("kinds > 1"), "suffix-keys")
    wanted = kinds.join(keys, "key").select("place.print", "place.start", "strings", "lead", "key",
                                            "digest")
    marks = shared_strings(piece_bodies(texts, wanted, width), width)
    copies = kinds.filter("copies > 1").select(
        "key", "digest", F.lit(0).alias("low"), F.col("strings").alias("high"))
    marked = common.stored(marks.unionAll(copies), "suffix-marks")
    return places.join(marked, ["key", "digest"]).select(
        "print", (F.col("start") + F.col("low")).alias("low"),
        (F.col("start") + F.col("high")).alias("high"))


def cut_out(body: bytes, spans: list[tuple[int, int]], width: int):
    """Removed runs (start, length) and the bytes kept, from the starts of repeated strings."""
    runs: list[list[int]] = []
    for low, high in sorted(spans):
        end = high + width - 1
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([low, end])
    kept, at = [], 0
    for low, end in runs:
        kept.append(body[at:low])
        at = end
    kept.append(body[at:])
    return [(low, end - low) for low, end in runs], b"".join(kept)


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))
    name = F.unhex(F.md5(body))
    return common.bounded_batches(df).select(
        F.col(key).alias("key"), body.alias("body"), name.alias("print"),
        F.xxhash64(name).alias("h"))


def deduplicated_texts(texts: DataFrame, width: int = WIDTH, **options) -> DataFrame:
    """(print, n_bytes, spans, kept) of every different text: removed runs (start, length), and
    the bytes that stay."""
    spans = common.stored(
        repeated_spans(texts, width, **options).groupBy("print").agg(
            F.collect_list(F.struct("low", "high")).alias("spans")), "suffix-spans")
    members = Members(spans.select(F.xxhash64("print").alias("h")), spans.count())
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    fields = pa.schema([("print", pa.binary()), ("n_bytes", pa.int64()), ("spans", pa.list_(kind)),
                        ("kept", pa.binary())])
    ddl = ("print binary, n_bytes long, spans array<struct<start: bigint, length: bigint>>, "
           "kept binary")

    def cut(batches):
        for batch in batches:
            made = []
            for name, body, some in zip(*(c.to_pylist() for c in batch.columns)):
                runs, kept = cut_out(body, [(s["low"], s["high"]) for s in some or ()], width)
                made.append((name, len(body), [{"start": a, "length": n} for a, n in runs], kept))
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*made), fields)], schema=fields)

    def untouched(batches):
        for batch in batches:
            keep = ~members.may_hold(np.asarray(batch.column(0), np.int64))
            batch = batch.filter(pa.array(keep))
            bodies = batch.column(2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([len(b) for b in bodies.to_pylist()], pa.int64()),
                 pa.array([[]] * len(bodies), pa.list_(kind)), bodies], schema=fields)

    rest = texts.select("h", "print", "body").mapInArrow(untouched, ddl)
    met = (one_each(of_members(texts, members)).join(spans, "print", "left")
           .select("print", "body", "spans").mapInArrow(cut, ddl))
    return rest.unionAll(met)


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                 **options) -> DataFrame:
    """(key, n_bytes, spans, kept) of every row."""
    texts = _texts(df, key, text)
    done = deduplicated_texts(texts, width, **options).dropDuplicates(["print"])
    return (texts.select("key", "print").join(done, "print").select("key", "n_bytes", "spans", "kept")
            .withColumnRenamed("key", key))


def query(spark, sf_dir: str) -> DataFrame:
    texts = _texts(common.documents(spark, sf_dir), "doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    digests = deduplicated_texts(texts).select(
        "print", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256")).dropDuplicates(["print"])
    return texts.select(F.col("key").alias("doc_id"), "print").join(digests, "print").drop("print")
