"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

1. Texts are cut where a rolling hash over 16 bytes has its 10 highest bits zero (chunks of 256 to
   8192 bytes, about 1.3 KB), so equal passages give equal chunks wherever they stand.
2. Chunks that occur twice or more are counted by a 128-bit digest; only digests are shuffled.
   Equal rows that follow each other, as a mixture makes them, count and are encoded as one.
3. Every shared chunk is encoded once, and its ids are joined to the places where it occurs.
4. A text's shared chunks bring their ids, the runs between them are encoded in place, and each join
   is repaired: the text between the last anchor before the join and the first anchor after it is
   encoded again. An anchor is a printable ASCII character followed by a space: the pre-tokeniser
   starts a new piece there whatever surrounds it, so ids before and after it are those of the
   whole text. Both sides must agree that a token starts at the anchor; where an anchor or the
   agreement is missing, the neighbours are joined and encoded as one. Ids are thus exactly those
   of the whole text, whatever is shared.

A bitmap of ``2^FILTER_BITS`` bits (1 MB, the only thing that passes the driver) tells tasks which
chunks may be shared. Texts without such a chunk are encoded where they are read; only the others
are shuffled. If the corpus outgrows the bitmap, more texts take the shuffled way, with equal results.

Special tokens in a text become their own ids, as in the tokenizers library. The vocabulary file is
a parameter; every task reads it from its own installation.

Defined cases: null text is empty and has no ids; rows are told apart by id and text, so null and
repeated ids are safe; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from faremill.llm import common

LEAST, MOST, WINDOW, CUT_BITS = 256, 8192, 16, 10
FILTER_BITS = 23
HASHED = 1 << 18              # bytes hashed at once
BATCH_BYTES = 2 << 20         # of texts that a task takes at once; it holds several copies
BATCH_IDS = 1 << 18           # ids that a task gives out at once
_GEAR = np.random.default_rng(42).integers(0, 1 << 32, 256, dtype=np.uint32)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Ids of a text and bytes of ids, for one vocabulary file."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        # byte-level vocabularies write bytes as printable characters: printable ones as
        # themselves, the others by order from code point 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in stored["model"]["vocab"].items()
                 if token not in special}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens=special)
        self.tokens = [b""] * (1 + max([*ranks.values(), *special.values()]))
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.tokens[i] = token
        self.lengths = np.array([len(t) for t in self.tokens])

    def encode(self, data: bytes) -> np.ndarray:
        return self.encoding.encode_to_numpy(data.decode("utf-8", "replace"),
                                             allowed_special="all", disallowed_special=())

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _candidates(buffer: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last WINDOW bytes asks for a cut."""
    found = [np.empty(0, np.int64)]
    for at in range(0, len(buffer), HASHED):  # hashes take many times the room of the bytes
        before = max(0, at - WINDOW + 1)
        h = _GEAR[buffer[before:at + HASHED]]
        width = 1
        while width < WINDOW:
            shifted = np.zeros_like(h)
            shifted[width:] = h[:-width] << np.uint32(width)
            h += shifted
            width *= 2
        found.append(np.flatnonzero(h[at - before:] >> np.uint32(32 - CUT_BITS) == 0) + at + 1)
    ends = np.concatenate(found)
    ends = ends[ends < len(buffer)]
    return ends[(buffer[ends] & 0xC0) != 0x80]  # never inside a character


def chunk_bounds(texts: list[bytes]) -> list[list[int]]:
    """Borders of the chunks of each text, from 0 to its length."""
    out: list[list[int]] = []
    start = 0
    while start < len(texts):  # some texts at once, of bounded size together
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= 1 << 22):
            size += len(texts[stop])
            stop += 1
        some = texts[start:stop]
        cuts = _candidates(np.frombuffer(b"".join(some), np.uint8)) if size else np.empty(0, int)
        at, first = 0, 0
        for text in some:
            last = int(np.searchsorted(cuts, at + len(text)))
            out.append(_choose(text, (cuts[first:last] - at).tolist()))
            first, at = last, at + len(text)
        start = stop
    return out


def _choose(text: bytes, cuts: list[int]) -> list[int]:
    bounds = [0]
    for cut in [*cuts, len(text)]:
        while cut - bounds[-1] > MOST:
            forced = bounds[-1] + MOST
            while text[forced] & 0xC0 == 0x80:
                forced -= 1
            bounds.append(forced)
        # the first LEAST bytes of a chunk make no cut, so no hash reaches beyond its text
        if cut - bounds[-1] >= LEAST and cut < len(text):
            bounds.append(cut)
    return [*bounds, len(text)] if len(text) > bounds[-1] else bounds


def chunk_key(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _slot(key: bytes) -> int:
    return int.from_bytes(key[:4], "big") >> (32 - FILTER_BITS)


def _may_share(bitmap: np.ndarray, key: bytes) -> bool:
    slot = _slot(key)
    return bool(bitmap[slot >> 6] >> np.uint64(slot & 63) & np.uint64(1))


def _anchor_after(data: bytes, start: int, end: int) -> int:
    """The first place > start with a space there and a printable ASCII character before it."""
    at = data.find(b" ", start + 1, end)
    while at >= 0 and not 33 <= data[at - 1] <= 126:
        at = data.find(b" ", at + 1, end)
    return at


def _anchor_before(data: bytes, start: int, end: int) -> int:
    at = data.rfind(b" ", start + 1, end)
    while at >= 0 and not 33 <= data[at - 1] <= 126:
        at = data.rfind(b" ", start + 1, at)
    return at


def assemble(data: bytes, bounds: list[int], known: dict[int, np.ndarray], model: Codec
             ) -> np.ndarray:
    """Ids of the whole text, given the ids of some of its chunks by place."""
    if not known:
        return model.encode(data) if data else np.empty(0, np.uint32)
    parts: list[list] = []  # start, end, ids or None
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        ids = known.get(i)
        if ids is None and parts and parts[-1][2] is None:
            parts[-1][1] = b
        else:
            parts.append([a, b, ids])
    while True:
        joined: list[list] = []
        for a, b, ids in parts:  # neighbours without anchors on both sides of a join become one
            if joined and (_anchor_after(data, a, b) < 0
                           or _anchor_before(data, joined[-1][0], joined[-1][1]) < 0):
                joined[-1][1], joined[-1][2] = b, None
            else:
                joined.append([a, b, ids])
        if len(joined) == len(parts):
            break
        parts = joined
    pieces: list[np.ndarray] = []
    for i, (a, b, ids) in enumerate(parts):
        ids = model.encode(data[a:b]) if ids is None else ids
        starts = a + np.concatenate([[0], np.cumsum(model.lengths[ids])])
        head = a if i == 0 else _anchor_after(data, a, b)
        tail = b if i == len(parts) - 1 else _anchor_before(data, a, b)
        x, y = np.searchsorted(starts, [head, tail])
        if starts[x] != head or starts[y] != tail:  # no agreement: the text is encoded as one
            return model.encode(data)
        pieces.append(ids[x:y])
        if i < len(parts) - 1:
            pieces.append(model.encode(data[tail:_anchor_after(data, *parts[i + 1][:2])]))
    return np.concatenate(pieces)


def _body(text: str):
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return common.bounded_batches(df, BATCH_BYTES).select(
        F.col(key).alias("key"), F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("name"),
        F.xxhash64(F.col(text).cast("string")).alias("print"), _body(text).alias("body"))


def merged_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with neighbours of equal name and print as one row, and their number as ``copies``."""
    n = batch.num_rows
    names, prints = batch.column("name"), batch.column("print")
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = (np.asarray(prints)[1:] != np.asarray(prints)[:-1]) | np.asarray(
            pc.not_equal(names[1:], names[:-1]))
    first = np.flatnonzero(new)
    kept = batch.take(pa.array(first))
    copies = np.diff(np.append(first, n)).astype(np.int32)
    return pa.RecordBatch.from_arrays([*kept.columns, pa.array(copies)],
                                      names=[*kept.schema.names, "copies"])


def _batch(fields, *columns):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def shared_chunks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored places (name, print, at, chunk) of the chunks of all texts, and the shared chunks."""
    fields = (("name", pa.string()), ("print", pa.int64()), ("at", pa.int32()),
              ("chunk", pa.binary()))

    def places(batches):
        for batch in map(merged_rows, batches):
            names, prints, bodies, _ = (c.to_pylist() for c in batch.columns)
            made = [(n, p, i, chunk_key(t[a:b]))
                    for n, p, t, bounds in zip(names, prints, bodies, chunk_bounds(bodies))
                    for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            yield _batch(fields, *(zip(*made) if made else ((),) * 4))

    found = common.stored(rows.select("name", "print", "body").mapInArrow(
        places, "name string, print long, at int, chunk binary"), "bpe-places")
    shared = found.groupBy("chunk").agg(F.count("*").alias("n")).filter("n > 1").select("chunk")
    return found, common.stored(shared, "bpe-shared")


def bitmap_of(shared: DataFrame) -> np.ndarray:
    """Bits of the shared chunks' first digits; at most 2^(FILTER_BITS - 6) words are collected."""
    slot = F.shiftrightunsigned(
        F.conv(F.hex(F.substring("chunk", 1, 4)), 16, 10).cast("long"), 32 - FILTER_BITS)
    words = (shared.select(F.shiftright(slot, 6).alias("word"),
                           F.expr("1L").alias("one"), slot.bitwiseAND(F.lit(63)).alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, cast(bit as int))")).alias("bits"))
             .collect())
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for row in words:
        out[row.word] = row.bits & (1 << 64) - 1
    return out


def encoded_chunks(rows: DataFrame, shared: DataFrame, bitmap, path: str) -> DataFrame:
    """(chunk, ids) of every shared chunk, each encoded once; ids as little-endian 32-bit bytes."""
    def proposed(batches):
        fields = (("chunk", pa.binary()), ("body", pa.binary()))
        seen: set[bytes] = set()  # a task offers a chunk once; 16 bytes for about 1.3 KB read
        for batch in batches:
            bodies = batch.column(0).to_pylist()
            found = {}
            for text, bounds in zip(bodies, chunk_bounds(bodies)):
                for a, b in zip(bounds, bounds[1:]):
                    chunk = chunk_key(text[a:b])
                    if chunk not in seen and _may_share(bitmap.value, chunk):
                        seen.add(chunk)
                        found[chunk] = text[a:b]
            yield _batch(fields, list(found), list(found.values()))

    def encoded(batches):
        fields = (("chunk", pa.binary()), ("ids", pa.binary()))
        for batch in batches:
            yield _batch(fields, batch.column(0).to_pylist(),
                         [codec(path).encode(t).astype("<u4").tobytes()
                          for t in batch.column(1).to_pylist()])

    return (rows.select("body").mapInArrow(proposed, "chunk binary, body binary")
            .join(shared, "chunk", "left_semi").dropDuplicates(["chunk"])
            .mapInArrow(encoded, "chunk binary, ids binary"))


def _digests(ids: np.ndarray, model: Codec) -> tuple[int, str, str]:
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(model.decode(ids).encode()).hexdigest())


def _contents(ids: np.ndarray, model: Codec) -> tuple[int, list[int]]:
    return len(ids), ids.astype(np.int32)


OUTPUTS = {
    "digests": (_digests, (("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"),
                           ("decoded_sha256", pa.string(), "string"))),
    "ids": (_contents, (("n_tokens", pa.int64(), "long"),
                        ("ids", pa.list_(pa.int32()), "array<int>"))),
}


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           output: str = "ids") -> DataFrame:
    """(key, n_tokens, ids) of every row, or counts and digests of ids and of the decoded text."""
    path = vocabulary or default_vocabulary()
    emit, columns = OUTPUTS[output]
    kind = df.schema[key].dataType.simpleString()
    rows = _rows(df, key, text)
    key_type = to_arrow_type(df.schema[key].dataType)
    places, shared = shared_chunks(rows)
    bitmap = df.sparkSession.sparkContext.broadcast(bitmap_of(shared))
    chunks = encoded_chunks(rows, shared, bitmap, path)
    brought = (places.join(shared, "chunk", "left_semi").distinct()
               .join(chunks, "chunk")
               .groupBy("name", "print").agg(F.collect_list(F.struct("at", "ids")).alias("known")))

    def may_meet(bodies):
        return [any(_may_share(bitmap.value, chunk_key(t[a:b])) for a, b in zip(bounds, bounds[1:]))
                for t, bounds in zip(bodies, chunk_bounds(bodies))]

    def sharing(batches):
        for batch in map(merged_rows, batches):
            yield batch.filter(pa.array(may_meet(batch.column("body").to_pylist()), pa.bool_()))

    fields = [pa.field("key", key_type), *(pa.field(n, t) for n, t, _ in columns)]

    def finished(batches):
        """Ids of texts with what is known of them, or of those that share nothing."""
        model = codec(path)
        for batch in batches:
            if "known" not in batch.schema.names:
                batch = merged_rows(batch)
                alone = [not x for x in may_meet(batch.column("body").to_pylist())]
                batch = batch.filter(pa.array(alone, pa.bool_()))
            keys, bodies, copies = (batch.column(n).to_pylist() for n in ("key", "body", "copies"))
            known = (batch.column("known").to_pylist() if "known" in batch.schema.names
                     else [None] * len(keys))
            made: list[list] = [[] for _ in fields]
            size = 0
            for k, t, times, some in zip(keys, bodies, copies, known):
                ready = {p["at"]: np.frombuffer(p["ids"], "<u4") for p in some or ()}
                ids = assemble(t, chunk_bounds([t])[0] if ready else [], ready, model)
                row = (k, *emit(ids, model))
                for _ in range(times):
                    for column, value in zip(made, row):
                        column.append(value)
                    size += len(ids)
                    if size > BATCH_IDS:  # bounds what a batch of ids holds
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(made, fields)],
                            schema=pa.schema(fields))
                        made, size = [[] for _ in fields], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(made, fields)], schema=pa.schema(fields))

    schema = f"key {kind}, " + ", ".join(f"{n} {t}" for n, _, t in columns)
    alone = rows.mapInArrow(finished, schema)
    met = (rows.mapInArrow(sharing, f"key {kind}, name string, print long, body binary, copies int")
           .join(brought, ["name", "print"], "left").select("key", "body", "copies", "known")
           .mapInArrow(finished, schema))
    return alone.unionAll(met).withColumnRenamed("key", key)


def query(spark, sf_dir: str) -> DataFrame:
    return encode(common.documents(spark, sf_dir), output="digests")
