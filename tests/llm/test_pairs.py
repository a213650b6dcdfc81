"""Near-duplicates and search against all pairs, and the pipeline."""

import random
import re

import numpy as np
import xxhash

import corpus_pipeline
from conftest import SF
from text_rows import edge_docs, no_docs  # noqa: F401
from faremill.llm import bpe, common, simhash, vector_search


def plain_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
                or [" ".join(words)]) if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    """Component of each value by looking at all pairs."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(values))]


def checked(rows, got):
    prints = [plain_print(r.text) for r in rows]
    roots = plain_components(prints, 2)
    low = {}
    for r, root in zip(rows, roots):
        if r.doc_id is not None:
            low[root] = min(low.get(root, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{p:016x}", low.get(root)) for r, p, root in zip(rows, prints, roots))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_components_against_all_pairs(spark, edge_docs, no_docs):
    for docs in (common.documents(spark, SF), edge_docs):
        checked(docs.select("doc_id", "text").collect(), simhash.near_duplicates(docs).collect())
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.deduplicated(no_docs).count() == 0


def clustered(rng, bits, n, flips):
    bases = [rng.getrandbits(bits) for _ in range(n // 8)]
    out = set()
    while len(out) < n:
        value = rng.choice(bases)
        for _ in range(rng.randint(0, flips)):
            value ^= 1 << rng.randrange(bits)
        out.add(value)
    return sorted(out)


def test_full_buckets_are_divided_without_loss(spark):
    values = clustered(random.Random(7), 64, 240, 3)
    nodes = common.stored(spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long"), "t")
    for bucket in (2, 4096):
        got = {r.node & simhash.ALL: r.root & simhash.ALL
               for r in simhash.components(simhash.links(nodes, bucket)).collect()}
        want = plain_components(values, 2)
        names = [got.get(v, v) for v in values]
        assert len(set(zip(want, names))) == len(set(want)) == len(set(names))


def test_wide_buckets_are_met_in_blocks(spark):
    values = clustered(random.Random(8), 256, 200, 6)
    nodes = common.stored(spark.createDataFrame([(v.to_bytes(32, "little"),) for v in values],
                                                "fp binary"), "t")
    want = plain_components(values, 20)
    for bucket in (4, 4096):
        got = {bytes(r.node): bytes(r.root) for r in
               simhash.components(simhash.wide_links(nodes, 20, bucket)).collect()}
        names = [got.get(b, b) for b in (v.to_bytes(32, "little") for v in values)]
        assert len(set(zip(want, names))) == len(set(want)) == len(set(names))


def test_bit_planes_count_distances():
    rng = random.Random(9)
    for bits, radius in ((64, 2), (256, 45), (64, 0), (64, 7)):
        values = clustered(rng, bits, 300, radius + 3)
        got = {(i, j) for i, found in simhash.near_members(values, bits, radius) for j in found}
        assert got == {(i, j) for j in range(300) for i in range(j)
                       if (values[i] ^ values[j]).bit_count() <= radius}


def test_any_two_near_fingerprints_share_a_bucket():
    rng = random.Random(10)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        level = [0]
        for _ in range(simhash.LEVELS):
            level = [s for m in level for s in simhash.masks(m) if a & s == b & s]
            assert level


def test_one_document_of_each_group_stays(spark, edge_docs):
    words = [f"w{i}" for i in range(300)]
    near = words.copy()
    near[150] = "changed"
    rows = [(i, " ".join(words), None, None, None) for i in (9, 4, 7)] + [
        (3, " ".join(near), None, None, None), (1, " ".join(reversed(words)), None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert sorted(r.doc_id for r in simhash.deduplicated(docs).collect()) == [1, 3]
    kept = simhash.deduplicated(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) <= 1 and 104 in ids and 105 in ids
    # null and blank texts have fingerprint zero: one of them stays, that with the smallest id
    assert {100, 101, 102} & set(ids) == {100}


def plain_search(rows, every, k):
    out = []
    good = [(i, np.floor(64 * np.array(v, float))) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, width - len(v))).astype(int)) for i, v in good]
    queries = {}
    for i, v in good:
        if i % every == 0:
            queries[i] = min(queries.get(i, tuple(v)), tuple(v))
    for q, v in queries.items():
        hits = sorted((-int(np.dot(v, w)), i) for i, w in good if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(hits, 1)]
    return sorted(out)


def test_search_against_all_pairs(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (303, [float("inf")] * 8),
             (304, []), (340, []), (305, [0.5, 0.5]), (None, [1.0] * 8), (20, [0.25] * 8), (41, rows[40][1]),
             (320, rows[40][1]), (-20, [3.0] * 8)]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows],
                                  "vec_id long, embedding array<double>, key string, rank string")
    for settings in ({}, {"block_rows": 40, "query_rows": 6, "bits": 2}, {"bits": 8}):
        got = vector_search.search(table, k=7, **settings).collect()
        assert sorted(map(tuple, got)) == plain_search(rows, 20, 7)
    assert vector_search.search(table.limit(0)).count() == 0
    empty = spark.createDataFrame([(20, []), (1, []), (2, [])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, vector_search.search(empty).collect())) == [(20, 1, 1, 0), (20, 2, 2, 0)]
    assert vector_search.search(table.limit(5), k=20).count() == 4


def test_few_exact_vectors_are_read():
    rng = np.random.default_rng(7)
    vectors = np.floor(64 * rng.normal(size=(4000, 16)) / 4).astype(np.int64)
    cells = vector_search.Cells({d: (int(vectors[:, d].min()), int(vectors[:, d].max()))
                                 for d in range(16)}, 5)
    class Counted(np.ndarray):
        read = 0
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                Counted.read += len(key)
            return super().__getitem__(key)
    ids = np.arange(4000)
    found = list(vector_search.block_search(ids, vectors.view(Counted), ids[:5], vectors[:5], cells, 10))
    assert len(found) == 5 and Counted.read < 0.2 * 5 * 4000


def test_stages_of_the_pipeline(spark, edge_docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "personal_data", "mixture", "encoding"]
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES:
        made = common.stored(stage(spark, docs, SF), "t")
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "encoding":
            assert made.columns == edge_docs.columns
            docs = made
    model = bpe.codec(bpe.default_vocabulary())
    texts = sorted(r.text or "" for r in docs.collect())
    assert sorted(model.decode(np.array(r.ids, np.int64)) for r in made.collect()) == texts
    assert all(r.n_tokens == len(r.ids) for r in made.collect())


def test_pipeline_over_the_tables(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 150 and {"doc_id", "n_tokens", "ids"} == set(rows[0].__fields__)


def plain_shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words \
        else frozenset()


def plain_kept(rows, similarity=0.8):
    """Smallest id of each component of the pairs at the Jaccard similarity, by all pairs that share
    a shingle."""
    sets = sorted({plain_shingles(t) for _, t in rows}, key=lambda s: (len(s), sorted(s)))
    parent, holders = list(range(len(sets))), {}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for j, own in enumerate(sets):
        counts = {}
        for shingle in own:
            for i in holders.get(shingle, ()):
                counts[i] = counts.get(i, 0) + 1
            holders.setdefault(shingle, []).append(j)
        for i, both in counts.items():
            if both / (len(own) + len(sets[i]) - both) >= similarity:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    place, low = {s: i for i, s in enumerate(sets)}, {}
    for k, t in rows:
        r = root(place[plain_shingles(t)])
        low[r] = min(low.get(r, k), k)
    return sorted(low.values())


def test_a_repeated_line_does_not_make_duplicates(spark):
    """Texts of different words that share one line 30 times are no near-duplicates."""
    rows = []
    for k in range(12):
        words = [f"w{k}x{i}" for i in range(200)]
        line = " all rights reserved by the owner of this page "
        rows.append((k, line.join(" ".join(words[i:i + 7]) for i in range(0, 200, 7)) + line * 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.deduplicated(docs).collect()) == plain_kept(rows) \
        == list(range(12))


def test_near_duplicates_against_brute_force(spark):
    """The table's documents, and 60 built pairs just above and just below the similarity."""
    docs = common.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    draw = random.Random(12)
    for k in range(60):
        words = [f"p{k}w{i}" for i in range(400)]
        other = words.copy()
        for at in draw.sample(range(5, 390, 6), 8 + k % 2):  # each changes 5 of 396 shingles
            other[at] = f"p{k}changed{at}"
        rows += [(10_000 + 2 * k, " ".join(words)), (10_001 + 2 * k, " ".join(other))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in simhash.deduplicated(table).collect())
    assert got == plain_kept(rows)
    built = [k for k in got if k >= 10_000]
    assert len(built) == 30 + 30 * 2  # similarities of 356/436 = 0.817 and 351/441 = 0.796


def test_sets_are_compared_along_fingerprint_links(spark):
    """The pipeline's sets carry the texts' fingerprints; near ones are tied, far ones are not."""
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, None)],
                                 "doc_id long, text string")
    named = simhash.named_sets(docs, "doc_id", "text", 5).collect()
    assert {r.key: r.print & simhash.ALL for r in named} == {
        1: simhash.fingerprint("one two three four five six"), 2: 0}
    draw = random.Random(14)
    far = [draw.getrandbits(62) for _ in range(3)]
    sets = spark.createDataFrame(
        [(10, far[0]), (11, far[0]), (12, far[0] ^ 5), (20, far[1]), (30, far[2])],
        "fp long, print long")
    assert {tuple(r) for r in simhash.print_pairs(sets).collect()} == {(10, 11), (10, 12)}


def test_prefixes_of_similar_sets_meet():
    draw = random.Random(13)
    for _ in range(300):
        n = draw.randint(1, 120)
        both = draw.sample(range(10_000), n)
        spare = int(n / 0.8 + 1e-9) - n
        cut = draw.randint(0, spare)
        one = sorted(both + list(range(20_000, 20_000 + cut)))
        other = sorted(both + list(range(-1, cut - spare - 1, -1)))
        a, b = (set(x[:simhash.prefix_size(len(x), 0.8)]) for x in (one, other))
        assert a & b


def test_edited_copies_below_the_similarity_are_not_compared_in_pairs(spark, monkeypatch):
    """Copies of one passage with three changed words each are similar at 0.55 to each other."""
    draw, rows = random.Random(15), []
    for k in range(200):
        words = [f"w{i}" for i in range(100)]
        for place in draw.sample(range(5, 95, 6), 3):
            words[place] = f"k{k}p{place}"
        rows.append((k, " ".join(words)))
    compared, confirmed = [], simhash.confirmed

    def counted(pairs, *rest):
        pairs = common.stored(pairs, "t")
        compared.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(simhash, "confirmed", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.deduplicated(docs).collect()) == plain_kept(rows)
    assert sum(compared) < 10 * len(rows)


def test_sketches_differ_in_no_more_bits_than_sets_in_members():
    draw = random.Random(16)
    for _ in range(100):
        both = [draw.getrandbits(64) for _ in range(draw.randint(0, 300))]
        sets = [both + [draw.getrandbits(64) for _ in range(draw.randint(0, 60))] for _ in range(2)]
        one, other = (simhash.sketch(np.array(s, np.uint64)).view(np.uint64).tolist() for s in sets)
        assert len(one) * 64 == simhash.SKETCH
        assert sum((a ^ b).bit_count() for a, b in zip(one, other)) <= sum(map(len, sets)) - 2 * len(both)
