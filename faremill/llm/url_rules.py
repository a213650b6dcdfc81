"""URL filtering by rules: given host and path rules first, mined token rules for the rest.

Pages that a given rule decides are the labelled ones. Spark's FP-growth mines combinations of URL
tokens (host labels, path segments, query names, scheme, with numbers folded) together with the
verdict, each verdict's pages on their own, so that a rare verdict gets its rules; rules "tokens ->
verdict" are pruned by support within their verdict and by confidence over all labelled pages, and a
rule is dropped if fewer of its tokens already give the same verdict with no less confidence. Tokens
that stand on exactly the same labelled pages are mined as one: sets of them say the same, and k of
them would make 2^k. A page that no given rule
decides takes the verdict of its most confident matching rule (ties: more pages, then allow), or
``allow`` if none matches.

Matching uses an inverted index: each rule is listed under its rarest token only, so a very common
token (``https``, ``com``) opens no list, and the listed rules are tested against the page's tokens.
Redundant rules are dropped by Spark, level by level of their size, before anything is collected, and
no other rule is dropped. Up to ``max_rules`` rules are sent to the tasks; more are matched by the
same index as a join, with the same verdicts.

Defined cases: a null url, or one without ``://``, has empty host and path, no token, no rule and
verdict allow; repeated rows repeat their verdict; without labelled pages no rule is mined; an empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.llm import common

#: Fixed rules of the query: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ?, # or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (rule, verdict), or null."""
    found = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens; digit runs fold to one sign, so page numbers don't make tokens of their
    own. A port or user part stays a part of its host label."""
    def named(prefix: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""),
                           lambda p: F.concat(F.lit(prefix), p))

    folded = F.regexp_replace(path, "[0-9]+", "#")
    asked = F.regexp_replace(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "=[^&]*", "")
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    return F.when(host != "", F.array_distinct(F.concat(
        named("scheme=", F.array(scheme)), named("host=", F.split(host, r"\.")),
        named("path=", F.split(folded, "/")), named("query=", F.split(asked, "&"))))
    ).otherwise(F.array().cast("array<string>"))


def counts_of(labelled: DataFrame) -> dict[str, int]:
    return {row.verdict: row["count"] for row in labelled.groupBy("verdict").count().collect()}


def token_groups(baskets: DataFrame, least: dict[str, int]) -> dict[str, str]:
    """Token -> its group's name, for tokens on enough pages of some verdict. Tokens that stand on
    exactly the same labelled pages are a group: rules cannot tell them apart.

    A page has a bounded number of tokens and a token a least share of pages, so few are returned."""
    page = F.xxhash64("id", "tokens", "verdict")
    enough = F.lit(False)
    for verdict, pages in least.items():
        enough = enough | (F.col(f"in {verdict}") >= pages)
    seen = (baskets.withColumn("page", page).withColumn("t", F.explode("tokens")).groupBy("t")
            .agg(*[F.count_if(F.col("verdict") == v).alias(f"in {v}") for v in least],
                 F.bit_xor("page").alias("mixed"),
                 F.sum(F.col("page").cast("decimal(38,0)")).alias("sum"))
            .filter(enough))
    same = F.struct(*[F.col(f"in {v}") for v in least], "mixed", "sum")
    return {row.t: row.name for row in seen.select("t", same.alias("same")).withColumn(
        "name", F.min("t").over(Window.partitionBy("same"))).select("t", "name").collect()}


def grouped(groups: dict[str, str]):
    """Expression of a token list -> the sorted names of its tokens' groups."""
    @F.pandas_udf("array<string>")
    def names(tokens):
        return tokens.map(lambda have: sorted({groups[t] for t in have if t in groups}))

    return names


def mined_rules(labelled: DataFrame, support: float = 0.01, confidence: float = 0.8,
                least_pages: int = 3) -> tuple[DataFrame, dict[str, str]]:
    """Stored rules (tokens, verdict, confidence, support) from (tokens, verdict) rows, and the group
    of each token: rules are over groups. A rule's pages are at least ``support`` of those of its
    verdict, and ``least_pages``. Rules of which fewer tokens give the same verdict with no less
    confidence are left out. ``support`` of a returned rule is its share of all labelled pages."""
    from pyspark.ml.fpm import FPGrowth

    kind = "tokens array<string>, verdict string, confidence double, support double"
    baskets = common.stored(labelled.select("tokens", "verdict").withColumn("id", F.expr("uuid()")),
                            "url-baskets")
    sizes = counts_of(baskets)
    least = {v: max(least_pages, math.ceil(support * n)) for v, n in sizes.items()}
    groups = token_groups(baskets, least) if sizes else {}
    if not groups:
        return labelled.sparkSession.createDataFrame([], kind), groups
    pages = common.stored(baskets.select(grouped(groups)("tokens").alias("tokens"), "verdict"),
                          "url-groups")
    sets = None
    for verdict, n in sorted(sizes.items()):
        model = FPGrowth(itemsCol="tokens", minSupport=(least[verdict] - 0.5) / n).fit(
            pages.filter(F.col("verdict") == verdict).select("tokens"))
        own = model.freqItemsets.select(F.array_sort("items").alias("tokens"),
                                        F.lit(verdict).alias("verdict"), "freq")
        sets = own if sets is None else sets.unionAll(own)
    sets = common.stored(sets, "url-itemsets")
    lists = common.stored(pages.groupBy("tokens").agg(F.count("*").alias("n")), "url-lists")
    # pages of all verdicts that have a set's tokens, by a join on the rarest of them
    rarity = lists.select(F.explode("tokens").alias("t"), "n").groupBy("t").agg(F.sum("n").alias("n"))
    rarest = (sets.select("tokens").distinct().withColumn("t", F.explode("tokens"))
              .join(rarity, "t").groupBy("tokens").agg(F.min(F.struct("n", "t"))["t"].alias("t")))
    with_tokens = (rarest.withColumnRenamed("tokens", "needed")
                   .join(lists.withColumn("t", F.explode("tokens")), "t")
                   .filter(F.size(F.array_except("needed", "tokens")) == 0)
                   .groupBy(F.col("needed").alias("tokens")).agg(F.sum("n").alias("pages")))
    sure = common.stored(sets.join(with_tokens, "tokens").select(
        "tokens", "verdict", (F.col("freq") / F.col("pages")).alias("confidence"),
        (F.col("freq") / F.lit(sum(sizes.values()))).alias("support"),
        F.size("tokens").alias("size")), "url-rules")
    # every subset of a frequent itemset is one, so the sizes follow without a gap
    longest = sure.agg(F.max("size")).first()[0] or 0
    levels = [common.stored(sure.filter("size = 1").withColumn("below", F.lit(0.0)), "url-level")]
    for size in range(2, longest + 1):
        own = sure.filter(F.col("size") == size)
        fewer = own.select("tokens", "verdict", F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)),
            lambda i: F.filter("tokens", lambda t, j: j != i))).alias("part"))
        before = levels[-1].select(F.col("tokens").alias("part"), "verdict",
                                   F.greatest("confidence", "below").alias("best"))
        best = (fewer.join(before, ["part", "verdict"]).groupBy("tokens", "verdict")
                .agg(F.max("best").alias("below")))
        levels.append(common.stored(own.join(best, ["tokens", "verdict"]).select(
            *levels[0].columns), "url-level"))
    return common.stored(reduce(DataFrame.unionAll, levels).filter(
        (F.col("confidence") >= confidence) & (F.col("below") < F.col("confidence")))
        .select("tokens", "verdict", "confidence", "support"), "url-kept"), groups


def ranked(rules: DataFrame) -> list[tuple[tuple[str, ...], str, float, float]]:
    """(tokens, verdict, confidence, support), best first."""
    return sorted(((tuple(r.tokens), r.verdict, r.confidence, r.support) for r in rules.collect()),
                  key=lambda r: (-r[2], -r[3], r[1], r[0]))


def mine(labelled: DataFrame, **mining) -> list[tuple[tuple[str, ...], str, float, float]]:
    """All rules from (tokens, verdict) rows, best first, with every token of each group."""
    found, groups = mined_rules(labelled, **mining)
    members: dict[str, list[str]] = {}
    for token, name in groups.items():
        members.setdefault(name, []).append(token)
    return sorted(((tuple(sorted(tokens)), *rest) for names, *rest in ranked(found)
                   for tokens in itertools.product(*(members[n] for n in names))),
                  key=lambda r: (-r[2], -r[3], r[1], r[0]))


def inverted(rules) -> dict[str, list[tuple[int, frozenset, str]]]:
    """Rules under their rarest token: the one in the fewest rules' support, then by name."""
    weight: dict[str, float] = {}
    for tokens, _, _, support in rules:
        for t in tokens:
            weight[t] = max(weight.get(t, 0.0), support)
    index: dict[str, list] = {}
    for place, (tokens, verdict, _, _) in enumerate(rules):
        index.setdefault(min(tokens, key=lambda t: (weight[t], t)), []).append(
            (place, frozenset(tokens), verdict))
    return index


def best_match(index, tokens) -> str:
    have = set(tokens)
    hits = [(place, verdict) for t in have for place, needed, verdict in index.get(t, ())
            if needed <= have]
    return min(hits)[1] if hits else "allow"


def matched(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined) of the distinct token lists that a rule fits, by a join on its rarest token."""
    parts = rules.withColumn("t", F.explode("tokens"))
    weights = parts.groupBy("t").agg(F.max("support").alias("weight"))
    listed = (parts.join(weights, "t").groupBy(F.col("tokens").alias("needed"), "verdict",
                                               "confidence", "support")
              .agg(F.min(F.struct("weight", "t"))["t"].alias("t")))
    place = F.struct(-F.col("confidence"), -F.col("support"), "verdict", "needed")
    return (tokens.distinct().withColumn("t", F.explode("tokens")).join(listed, "t")
            .filter(F.size(F.array_except("needed", "tokens")) == 0)
            .groupBy("tokens").agg(F.min(place)["verdict"].alias("mined")))


def judge(df: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
          max_rules: int = 2000, **mining) -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``df``."""
    address = F.col(url).cast("string")
    parts = df.select(F.col(key), host_of(address).alias("host"), path_of(address).alias("path"),
                      address.alias("address"))
    decided = parts.withColumn("given", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "tokens", tokens_of(F.col("address"), F.col("host"), F.col("path")))
    found, groups = mined_rules(decided.filter("given is not null").select(
        "tokens", F.col("given.verdict").alias("verdict")), **mining)
    if found.count() > max_rules:
        decided = decided.withColumn("tokens", grouped(groups)("tokens"))
        fits = matched(decided.filter("given is null").select("tokens"), found)
        judged = decided.join(fits, "tokens", "left").withColumn(
            "open", F.coalesce("mined", F.lit("allow")))
    else:
        index = inverted(ranked(found))

        @F.pandas_udf("string")
        def mined(tokens):
            return tokens.map(lambda have: best_match(
                index, {groups[t] for t in have if t in groups}))

        judged = decided.withColumn("open", mined("tokens"))
    return judged.select(key, "host", "path", F.col("given.rule").alias("rule"),
                         F.coalesce("given.verdict", "open").alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
