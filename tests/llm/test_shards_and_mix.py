import os
import sys
from collections import Counter, defaultdict

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402
from text_rows import edge_docs, no_docs  # noqa: E402, F401
from faremill.llm import common, mixing, sharding  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_sharding", "op4_topk_search", "op8_mixing"])
def test_queries_against_sql(spark, name):
    same, detail = compare(spark, connect(SF), name, entry.queries()[name],
                           entry.oracle_sql()[name], SF)
    assert same, detail


def test_all_operators_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names


@pytest.mark.parametrize("bucket_rows", [3, 4000])
def test_shards_of_edge_rows(edge_docs, bucket_rows):
    got = sharding.shard(edge_docs, shards=4, bucket_rows=bucket_rows).collect()
    assert len(got) == edge_docs.count()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == {0, 1, 2, 3} and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    for source in ("s0", "s1", "s2", None):
        of = Counter(r.shard for r in got if r.source == source)
        counts = [of[i] for i in range(4)]
        assert max(counts) - min(counts) <= 2
    again = sharding.shard(edge_docs.repartition(5), shards=4, bucket_rows=3).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))  # neither layout nor buckets count


def test_no_rows(no_docs):
    assert sharding.shard(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def targets_by_hand(sizes, weights):
    total, out, free = 1.5 * sum(sizes.values()), {}, dict(weights)
    while True:
        share = (total - sum(out.values())) / sum(free.values())
        over = [s for s in free if free[s] * share > 2 * sizes[s]]
        if not over:
            return out | {s: free[s] * share for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            del free[s]


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 100, "c": 1000, "d": 5}, {"a": 1, "b": 1, "c": 1}, {"a": 50, "b": 50}, {"a": 7},
    {"a": 0, "b": 10, "c": 0, "d": 400}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(f"0{s}", n) for s, n in sizes.items()],
                                 "stratum string, source_size long")
    got = {r.stratum[1:]: r.target for r in mixing.targets(rows).collect()}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    want = targets_by_hand({s: max(n, 0) for s, n in sizes.items()}, weights)
    assert got == pytest.approx(want)


def test_mix_of_edge_rows(edge_docs):
    for bucket_rows in (2, 4000):
        got = mixing.mix(edge_docs, bucket_rows=bucket_rows).collect()
        assert len(got) == edge_docs.count()
        assert all(0 <= r.taken <= 2 * r.size and r.taken in (0, r.size, 2 * r.size) for r in got)
    assert {r.size for r in got if r.doc_id in (100, 101, 102)} == {0}
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(edge_docs.repartition(3)).collect()))


def test_taken_words_come_near_targets(spark):
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    docs = common.documents(spark, "/root/testdata/sf0.01")
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in target)


def test_mixed_rows_are_repeated(edge_docs):
    mixed = mixing.mixed(edge_docs)
    assert mixed.columns == edge_docs.columns
    want = Counter()
    for r in mixing.mix(edge_docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +want
