"""Near-duplicates: SimHash by bit-sliced comparison, and exact Jaccard similarity.

* ``near_duplicates``: a text's fingerprint has the 64 bits that over half of its 3-word shingles'
  hashes have. Two fingerprints that differ in up to two bits are linked; every link is found.
* ``deduplicated``: two texts are linked if the sets of their 5-word shingles have a Jaccard
  similarity of 0.8; every link is found, and no other is made.

A component is what links reach. The fingerprints:

1. Distinct fingerprints only, each with its smallest id: groups of copies are one row from here on.
2. Buckets. Fingerprints within two bits agree on two of four bands of 16 bits, so each goes into six
   buckets, one per pair of bands. A bucket of over ``BUCKET`` members is divided again: its free bits
   are cut into three parts, of which two near fingerprints agree on one; so 32 agreed bits become
   about 43 and then 50, and the last buckets hold at most 2^14 fingerprints. Nothing is dropped.
3. Inside a bucket the members' bits are stored as planes (bit p of every member in one long
   integer). For one member the planes are compared one by one; carry-save counters add up all
   distances at once, and a block is left as soon as every distance in it exceeds the radius.
   Buckets give a spanning forest of their links, never all pairs.
4. Components of the forests' edges by alternating large and small stars, one stored table a round.

The shingle sets (``jaccard_links``), which are made again from the texts where they are needed, as
they take more room than these:

1. One text for each set of 64-bit shingle hashes. All sets are brought into one order: by hash, but
   hashes that several of a sample of the texts hold come last, the most frequent at the end. The
   order decides the cost, not the result.
2. Two sets at similarity s have one of the first n - ceil(s n) + 1 shingles of each in common (n its
   size), so the sets that list a shingle among these are all that can be similar by it.
3. Some pairs tie groups of edited copies together without all their pairs: along the forests of the
   fingerprints' links as above, each text with the smallest that has two of its ``HUBS`` smallest
   hashes, and in each list of step 2 each set with ``STARS`` of the list, the same in other lists.
4. Pairs of a list whose sets are in different components of step 3. Two sets of sizes m and n need
   an overlap of s (m + n) / (1 + s). The first shingle they share stands before the last places that
   leave so many; and their sketches, the parity of the hashes that fall on each of ``SKETCH`` bits,
   differ in no more bits than the sets may in shingles. Other pairs are left out.
5. The pairs of steps 3 and 4 are confirmed by the two whole sets. Components as above.

``wide_links`` links fingerprints of 256 bits that share a table's sampled bits. It misses links and
makes wrong ones, so the pipeline does not use it.

Defined cases: null text and text without words have fingerprint zero, which links like any other,
and an empty set, which links to empty sets only; with fewer words than a shingle the whole sequence
is the shingle; rows with a null id take part and get the smallest id of their component, null if it
has none; repeated rows repeat their result; an empty table gives no rows; other columns are ignored
(and kept by ``deduplicated``)."""

from __future__ import annotations

import math
import random
from functools import reduce
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from faremill.llm import common

BITS, RADIUS, SEED = 64, 2, 42
BUCKET = 4096
BLOCK = 1024  # members compared at once
ALL = (1 << BITS) - 1
WIDE, TABLES, SAMPLED = 256, 48, 18
HUBS = 4  # shingles of a text by which it meets the smallest text that has them too
STARS = 3  # sets of a list that all of it are compared to
SKETCH = 512
SAMPLE_TEXTS, OFTEN, MAX_OFTEN = 20_000, 2, 200_000  # texts that tell which shingles are frequent


def shingle_hashes(text: str | None, words: int) -> list[int]:
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)] if found else []
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED)
            for a, b in zip(starts[:len(found) - words + 1].tolist(), ends[words - 1:].tolist())]


def fingerprint(text: str | None, words: int = 3, bits: int = BITS) -> int:
    """Bit i is set if over half of the hashes have it; wider ones mix each hash to more bits."""
    hashes = np.array(shingle_hashes(text, words), np.uint64)
    out = 0
    for k in range(bits // 64):
        mixed = hashes
        if k:
            mixed = hashes + np.uint64(k * 0x9E3779B97F4A7C15 & ALL)
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(31)
        counts = np.zeros(64, np.int64)
        for i in range(0, len(mixed), 1 << 16):
            part = np.ascontiguousarray(mixed[i:i + (1 << 16)])
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                    bitorder="little").sum(0, dtype=np.int64)
        out |= sum(1 << (64 * k + int(i)) for i in np.flatnonzero(2 * counts > len(hashes)))
    return out


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def near_members(values: list[int], bits: int, radius: int, agreed: int = 0):
    """(i, [j > i within the radius]) of distinct fingerprints that agree on the agreed bits.

    The counters are planes of binary digits that start at 2^digits - 1 - radius, so the carry out
    of the last digit marks the members whose distance has just passed the radius."""
    free = [p for p in range(bits) if not agreed >> p & 1]
    digits = (radius + 1).bit_length()
    start_value = (1 << digits) - 1 - radius
    size = bits // 8
    for start in range(0, len(values), BLOCK):
        block = values[start:start + BLOCK]
        raw = np.frombuffer(b"".join(v.to_bytes(size, "little") for v in block), np.uint8)
        columns = np.unpackbits(raw.reshape(-1, size), axis=1, bitorder="little").T
        packed = np.packbits(columns, axis=1, bitorder="little")
        planes = [int.from_bytes(packed[p].tobytes(), "little") for p in free]
        everyone = (1 << len(block)) - 1
        zero = [everyone if start_value >> d & 1 else 0 for d in range(digits)]
        for i, value in enumerate(values[:start + len(block)]):
            far = (1 << max(0, i + 1 - start)) - 1  # the members up to i count as far
            counter = zero.copy()
            for p, plane in zip(free, planes):
                carry = plane ^ everyone if value >> p & 1 else plane
                for d in range(digits):
                    counter[d], carry = counter[d] ^ carry, counter[d] & carry
                    if not carry:
                        break
                else:
                    far |= carry
                    if far == everyone:
                        break
            near = everyone & ~far
            found = []
            while near:
                low = near & -near
                found.append(start + low.bit_length() - 1)
                near ^= low
            if found:
                yield i, found


def forest(values: list[int], bits: int = BITS, radius: int = RADIUS, agreed: int = 0):
    """(member, root) of the components inside one bucket, without the roots themselves."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if len(values) < 64:  # planes would not fill a machine word
        pairs = ((i, [j for j in range(i + 1, len(values))
                      if (value ^ values[j]).bit_count() <= radius])
                 for i, value in enumerate(values)) if bits != BITS else near_members(
                     values, bits, radius, agreed)
    else:
        pairs = near_members(values, bits, radius, agreed)
    for i, found in pairs:
        for j in found:
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    for i in range(len(values)):
        if root(i) != i:
            yield i, root(i)


def _forests(rows: DataFrame, bits: int, radius: int) -> DataFrame:
    """Edges (a, b) inside the buckets (mask, key) of rows (mask, key, fp). Sorted buckets stream
    through the tasks; each is of bounded size."""
    wide = bits != BITS
    kind, arrow = ("binary", pa.binary()) if wide else ("long", pa.int64())

    def edges(batches):
        def members():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

        out: list = []
        for (mask, _), bucket in groupby(members(), key=lambda row: row[:2]):
            names = sorted({row[2] for row in bucket})
            if len(names) > 1:
                values = [int.from_bytes(x, "little") for x in names] if wide else [
                    x & ALL for x in names]
                out += [(names[i], names[j]) for i, j in forest(
                    values, bits, radius, 0 if wide else mask & ALL)]
            if len(out) > 10_000:
                yield _edge_batch(out, arrow)
                out = []
        yield _edge_batch(out, arrow)

    return (rows.select("mask", "key", "fp").repartition("mask", "key")
            .sortWithinPartitions("mask", "key").mapInArrow(edges, f"a {kind}, b {kind}"))


def _edge_batch(rows, kind):
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], kind),
                                       pa.array([b for _, b in rows], kind)], names=["a", "b"])


def masks(mask: int = 0) -> list[int]:
    """Masks of the next level: pairs of four bands at first, then one of three parts of what is
    free. Any two fingerprints within two bits that agree on mask agree on one of these."""
    free = [p for p in range(BITS) if not mask >> p & 1]
    parts, take = (4, 2) if not mask else (3, 1)
    bounds = [round(i * len(free) / parts) for i in range(parts + 1)]
    bands = [sum(1 << p for p in free[a:b]) for a, b in zip(bounds, bounds[1:])]
    return [mask | sum(chosen) for chosen in combinations(bands, take)]


LEVELS = 3


def _bucketed(rows: DataFrame, wider: dict[int, list[int]]) -> DataFrame:
    """Rows (fp, mask) moved into the buckets of the next level's masks."""
    table = F.create_map(*[x for m, subs in wider.items() for x in (
        F.lit(signed(m)), F.array(*[F.lit(signed(s)) for s in subs]))])
    return (rows.select("fp", F.explode(table[F.col("mask")]).alias("mask"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """A forest of edges with the components of all links within two of 64 bits."""
    found, wider = [], {0: masks()}
    rows = nodes.select("fp", F.lit(0).cast("long").alias("mask"))
    for level in range(LEVELS):
        rows = _bucketed(rows, wider)
        sizes = common.stored(rows.groupBy("mask", "key").agg(F.count("*").alias("n"))
                              .filter("n > 1"), "simhash-buckets")
        last = level == LEVELS - 1
        fits = sizes if last else sizes.filter(F.col("n") <= bucket)
        found.append(common.stored(_forests(
            rows.join(fits.select("mask", "key"), ["mask", "key"], "left_semi"), BITS, RADIUS),
            "simhash-links"))
        over = sizes.filter(F.col("n") > bucket)
        if last or over.isEmpty():
            break
        rows = rows.join(over.select("mask", "key"), ["mask", "key"], "left_semi").select(
            "fp", "mask")
        wider = {sub: masks(sub) for subs in wider.values() for sub in subs}
    return reduce(DataFrame.unionAll, found)


def sampled_bits(tables: int = TABLES, size: int = SAMPLED, bits: int = WIDE) -> list[list[int]]:
    """The bits of each table: disjoint within a shuffle of all bits, as far as they go."""
    draw, out, left = random.Random(SEED), [], []
    for _ in range(tables):
        if len(left) < size:
            left = draw.sample(range(bits), bits)
        out.append(left[:size])
        left = left[size:]
    return out


def wide_radius(similarity: float, bits: int = WIDE) -> int:
    """Bits that differ at a Jaccard similarity (cosine 2s / (1 + s)), and a standard error more."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * share + math.sqrt(bits * share * (1 - share)))


def wide_links(nodes: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """A forest of edges of the links within the radius of 256 bits that share a table's bits."""
    tables = sampled_bits()

    def placed(batches):
        weights = 1 << np.arange(SAMPLED)
        for batch in batches:
            names = batch.column(0)
            if not len(names):
                continue
            raw = np.frombuffer(b"".join(names.to_pylist()), np.uint8).reshape(len(names), -1)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.int32)
            for t, chosen in enumerate(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), t), pa.int64()),
                     pa.array(bits[:, chosen] @ weights, pa.int64()), names],
                    names=["mask", "key", "fp"])

    rows = nodes.select("fp").mapInArrow(placed, "mask long, key long, fp binary")
    sizes = common.stored(rows.groupBy("mask", "key").agg(F.count("*").alias("n"))
                          .filter(F.col("n") > bucket), "simhash-large")
    if sizes.isEmpty():
        return common.stored(_forests(rows, WIDE, radius), "simhash-links")
    fits = rows.join(sizes, ["mask", "key"], "left_anti")
    cuts = F.ceil(F.col("n") / (bucket // 2)).cast("int")
    blocks = (rows.join(sizes, ["mask", "key"])
              .withColumn("own", F.pmod(F.xxhash64("fp"), cuts).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1)))
              .withColumn("mask", F.concat_ws(":", "mask", "key",
                                              F.least("own", "other"), F.greatest("own", "other")))
              .select(F.xxhash64("mask").alias("mask"), "key", "fp"))
    return common.stored(_forests(fits, WIDE, radius), "simhash-links").unionAll(
        common.stored(_forests(blocks, WIDE, radius), "simhash-links"))


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b); root is the smallest node.

    Large star: every neighbour above a node is tied to the smallest of its neighbourhood. Small
    star: the same for the neighbours below. When a round changes nothing, all edges end at roots."""
    def star(rows: DataFrame, both: bool) -> DataFrame:
        turned = rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = turned.unionAll(turned.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
            if both else turned
        # stored, so that both sides of the join are plain shuffles, and AQE can split a hot centre
        low = common.stored(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")),
                            "simhash-low")
        tied = near.join(low, "a")
        if both:
            made = tied.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            made = tied.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(
                low.select("a", F.col("low").alias("b")))
        return made.filter("a != b").distinct()

    def mark(rows: DataFrame):
        return tuple(rows.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = common.stored(edges.filter("a != b").distinct(), "simhash-star")
    before = mark(edges)
    for _ in range(max_rounds):
        edges = common.stored(star(star(edges, True), False), "simhash-star")
        now = mark(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def fingerprints(df: DataFrame, key: str, text: str, words: int, bits: int = BITS) -> DataFrame:
    """Stored rows (key, text_hash, fp); fp is a long, or bytes if it is wider."""
    def rows(keys, hashes, texts):
        for k, h, t in zip(keys, hashes, texts):
            value = fingerprint(t, words, bits)
            yield k, h, signed(value) if bits == BITS else value.to_bytes(bits // 8, "little")

    kind = df.schema[key].dataType.simpleString()
    body = F.col(text).cast("string")
    return common.stored(common.map_texts(
        df.select(F.col(key), F.xxhash64(body).alias("h"), body), rows,
        f"key {kind}, text_hash long, fp {'long' if bits == BITS else 'binary'}"),
        "simhash-prints")


def grouped(prints: DataFrame, linked) -> DataFrame:
    """Adds root, the name of the component, and component_id, its smallest key."""
    nodes = common.stored(prints.groupBy("fp").agg(F.min("key").alias("low")), "simhash-nodes")
    roots = components(linked(nodes))
    rooted = common.stored(nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    lows = common.stored(rooted.groupBy("root").agg(F.min("low").alias("component_id")),
                         "simhash-lows")
    named = common.stored(rooted.join(lows, "root").select("fp", "root", "component_id"),
                          "simhash-named")
    return prints.join(named, "fp")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3,
                    bucket: int = BUCKET) -> DataFrame:
    """(key, fingerprint, component_id) of every row."""
    found = grouped(fingerprints(df, key, text, words), lambda nodes: links(nodes, bucket))
    return found.select(F.col("key").alias(key),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def sketch(members: np.ndarray) -> np.ndarray:
    """Longs of ``SKETCH`` bits: whether an odd number of hashes falls on each. A hash that only one
    of two sets has flips one bit, so the sketches differ in at most as many bits as the sets do."""
    odd = np.bincount((members % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def named_sets(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Stored rows (key, text_hash, fp, size, hubs, print, sketch): fp names the set, hubs are its
    first hashes, print is the text's fingerprint as in ``near_duplicates``."""
    def rows(keys, hashes, texts):
        for k, h, t in zip(keys, hashes, texts):
            members = shingle_set(t, words)
            yield (k, h, signed(xxhash.xxh3_64_intdigest(members.tobytes(), SEED)), len(members),
                   members[:HUBS].view(np.int64).tolist(), signed(fingerprint(t)),
                   sketch(members).tolist())

    kind = df.schema[key].dataType.simpleString()
    body = F.col(text).cast("string")
    return common.stored(common.map_texts(
        df.select(F.col(key), F.xxhash64(body).alias("h"), body), rows,
        f"key {kind}, text_hash long, fp long, size int, hubs array<long>, print long, "
        "sketch array<long>"),
        "shingle-sets")


def frequent_shingles(texts: DataFrame, words: int, n_sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes that at least ``OFTEN`` of about ``SAMPLE_TEXTS`` texts hold, and the rank of
    each by frequency, the rarest first."""
    def exploded(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle_set(text, words).view(np.int64))], names=["h"])

    share = F.shiftrightunsigned(F.xxhash64("fp"), 1) / F.lit(float(1 << 63))
    some = texts.filter(share < SAMPLE_TEXTS / max(1, n_sets)).select("body")
    found = (common.bounded_batches(some).mapInArrow(exploded, "h long").groupBy("h")
             .agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN)
             .orderBy(F.desc("n"), "h").limit(MAX_OFTEN).collect())
    hashes = np.array([r.h for r in found], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (len(found) - 1 - order).astype(np.int32)


def prefix_size(size: int, similarity: float) -> int:
    """So many first members of a set hold one of every set at the similarity, and it is among as
    many of that set; a rounding error only makes it larger."""
    return min(size, size - math.ceil(similarity * size - 1e-6) + 1)


def prefixes(texts: DataFrame, words: int, frequent: tuple[np.ndarray, np.ndarray],
             similarity: float) -> DataFrame:
    """(h, fp, at, size) of the first members of the sets of texts (fp, body), at from 0."""
    hashes, ranks = frequent

    def first(batches):
        for batch in batches:
            made, sizes = [], []
            for text in batch.column(1).to_pylist():
                members = shingle_set(text, words)
                sizes.append(len(members))
                if len(hashes):
                    spots = np.minimum(np.searchsorted(hashes, members), len(hashes) - 1)
                    late = hashes[spots] == members
                    members = np.concatenate(
                        [members[~late], members[late][np.argsort(ranks[spots[late]])]])
                made.append(members[:prefix_size(len(members), similarity)])
            if made:
                counts = [len(m) for m in made]
                row = np.repeat(np.arange(len(made)), counts)
                at = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(made).view(np.int64)),
                     batch.column(0).take(pa.array(row)), pa.array(at),
                     pa.array(np.array(sizes, np.int32)[row])], names=["h", "fp", "at", "size"])

    return common.bounded_batches(texts.select("fp", "body")).mapInArrow(
        first, "h long, fp long, at int, size int")


def may_be_similar(one, other, similarity: float):
    """Whether sets (fp, at, size) that share the members at these places can reach the similarity if
    they share none before."""
    least, most = F.least(one["size"], other["size"]), F.greatest(one["size"], other["size"])
    overlap = F.ceil((one["size"] + other["size"]) * (similarity / (1 + similarity)) - 1e-3)
    return ((least >= most * similarity - 1e-3) & (one["at"] <= one["size"] - overlap)
            & (other["at"] <= other["size"] - overlap))


def star_pairs(lists: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of the lists (h, fp, at, size) with ``STARS`` sets of each list."""
    stars = lists.groupBy("h").agg(*(F.min(F.struct(
        F.xxhash64("fp", F.lit(k)).alias("r"), "fp", "at", "size")).alias(f"star{k}")
        for k in range(STARS)))
    one = F.struct("fp", "at", "size")
    return (lists.join(stars, "h").select(
        one.alias("one"), F.explode(F.array_distinct(F.array(
            *(F.struct(*(f"star{k}.{c}" for c in ("fp", "at", "size"))) for k in range(STARS)))))
        .alias("star"))
        .filter((F.col("one.fp") != F.col("star.fp"))
                & may_be_similar(F.col("one"), F.col("star"), similarity))
        .select(F.least("one.fp", "star.fp").alias("a"), F.greatest("one.fp", "star.fp").alias("b")))


def list_pairs(lists: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of the lists (h, fp, at, size, root, sketch) across roots that can reach the
    similarity by their first common member, their sizes and their sketches."""
    words = [f"sketch{i}" for i in range(SKETCH // 64)]
    rows = lists.select("h", "fp", "at", "size", "root",
                        *(F.col("sketch")[i].alias(w) for i, w in enumerate(words)))
    one, other = (rows.select("h", *(F.col(c).alias(c + x) for c in rows.columns if c != "h"))
                  for x in "12")
    first, second = ({c: F.col(c + x) for c in rows.columns if c != "h"} for x in "12")
    overlap = F.ceil((first["size"] + second["size"]) * (similarity / (1 + similarity)) - 1e-3)
    differ = reduce(lambda a, b: a + b, (
        F.bit_count(first[w].bitwiseXOR(second[w])) for w in words))
    return (one.join(other, "h").filter(
        (first["fp"] < second["fp"]) & (first["root"] != second["root"])
        & may_be_similar(first, second, similarity)
        & (differ <= first["size"] + second["size"] - 2 * overlap))
        .select(F.col("fp1").alias("a"), F.col("fp2").alias("b")).distinct())


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The stored pairs (a, b) whose sets have at least the Jaccard similarity."""
    def check(batches):
        last, one = None, np.empty(0, np.uint64)
        for batch in batches:
            good = []
            for i, (a, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)))):
                if a != last:
                    last, one = a, shingle_set(x, words)
                other = shingle_set(y, words)
                both = len(np.intersect1d(one, other, assume_unique=True))
                if both / max(1, len(one) + len(other) - both) >= similarity:
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    pairs = common.stored(pairs, "shingle-pairs")
    firsts = common.stored(pairs.select("a").distinct(), "shingle-firsts")
    # narrow pairs come to the texts, so that only texts in pairs are shuffled
    ones = texts.select(F.col("fp").alias("a"), F.col("body").alias("x")).join(
        common.small_side(firsts), "a", "left_semi")
    others = texts.select(F.col("fp").alias("b"), F.col("body").alias("y")).join(
        common.small_side(pairs), "b")
    rows = others.join(ones, "a").select("a", "b", "x", "y")
    return common.stored(common.bounded_batches(rows).mapInArrow(check, "a long, b long"),
                         "shingle-links")


def print_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets (fp, print) that tie all whose fingerprints SimHash links: equal ones to
    the smallest set that has it, and these along the forests of the links within two bits."""
    nodes = common.stored(sets.groupBy("print").agg(F.min("fp").alias("low")), "simhash-nodes")
    equal = sets.join(nodes, "print").filter("fp != low").select(
        F.col("low").alias("a"), F.col("fp").alias("b"))
    edges = links(nodes.select(F.col("print").alias("fp")))
    ends = [nodes.select(F.col("print").alias(side), F.col("low").alias(f"low_{side}"))
            for side in "ab"]
    linked = edges.join(ends[0], "a").join(ends[1], "b").select(
        F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
    return equal.unionAll(linked)


def jaccard_links(prints: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Edges with the components of all links between the distinct sets of ``prints`` (fp, size,
    hubs, print, sketch), whose texts are (fp, body)."""
    sets = common.stored(prints.groupBy("fp").agg(F.first("hubs").alias("hubs"),
                                                  F.first("sketch").alias("sketch"),
                                                  F.min("print").alias("print")), "shingle-named")
    each = common.stored(sets.select("fp", F.explode("hubs").alias("h")), "shingle-hubs")
    lows = common.stored(each.groupBy("h").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
                         .filter("n > 1").select("h", "a"), "shingle-lows")
    hubs = (each.join(lows, "h").filter("fp != a").groupBy("a", F.col("fp").alias("b"))
            .count().filter("count > 1").select("a", "b"))
    frequent = frequent_shingles(texts, words, sets.count())
    same = Window.partitionBy("h")
    lists = common.stored(prefixes(texts, words, frequent, similarity)
                          .withColumn("low", F.min("fp").over(same))
                          .withColumn("high", F.max("fp").over(same))
                          .filter("low < high").drop("low", "high"), "shingle-lists")
    ties = hubs.unionAll(print_pairs(sets)).unionAll(star_pairs(lists, similarity))
    roots = components(confirmed(ties.distinct(), texts, words, similarity))
    rooted = common.stored(sets.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "sketch"), "shingle-roots")
    open_lists = common.stored(
        lists.join(rooted.select("fp", "root"), "fp")
        .withColumn("low", F.min("root").over(same)).withColumn("high", F.max("root").over(same))
        .filter("low < high").drop("low", "high"), "shingle-open")
    pairs = list_pairs(open_lists.join(rooted.select("fp", "sketch"), "fp"), similarity)
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(
        confirmed(pairs, texts, words, similarity))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                 similarity: float = 0.8) -> DataFrame:
    """One row of ``df`` for each component: the one with the smallest id (null last), then the
    smallest text hash; of rows equal in both, any one."""
    prints = named_sets(df, key, text, words)
    order = F.struct(F.col("key").isNull().alias("none"), "key", "text_hash")

    def name(column):
        return F.coalesce(column.cast("string"), F.lit("null")).alias("name")

    ones = common.stored(prints.groupBy("fp").agg(F.min(order).alias("one")).select(
        "fp", name(F.col("one.key")), F.col("one.text_hash").alias("text_hash")), "shingle-ones")
    body = F.col(text).cast("string")
    texts = common.stored(
        df.select(name(F.col(key)), F.xxhash64(body).alias("text_hash"), body.alias("body"))
        .join(common.small_side(ones), ["name", "text_hash"]).select("fp", "body"), "shingle-texts")
    found = grouped(prints.select("key", "text_hash", "fp"), lambda nodes: jaccard_links(
        prints, texts, words, similarity))
    first = found.groupBy("root").agg(F.min(order).alias("kept"))
    kept = first.select(name(F.col("kept.key")), F.col("kept.text_hash").alias("text_hash"))
    rows = df.select(common.whole_row(df).alias("row"), name(F.col(key)),
                     F.xxhash64(body).alias("text_hash"))
    one = Window.partitionBy("name", "text_hash").orderBy("name")
    return (rows.join(kept, ["name", "text_hash"], "left_semi")
            .withColumn("at", F.row_number().over(one)).filter("at = 1").select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir))
