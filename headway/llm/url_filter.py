r"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

A rule is (host, path, action). It fits a url whose host equals the rule's or ends in "." + it, and whose path starts with
the rule's; of several that fit, the longest host + path wins, then the longest host. Every rule is listed under its
canonical url, host + path. A url's candidates are its host's suffixes of a listed number of labels times the prefixes of its
path that have a listed length. The filter is an array of 64-bit words, four to a block, sized by the number of rules; a
candidate's block and its bit in each word come from one XXH64, so a probe reads one block. A url that passes nowhere gets
the default at once; the others are joined to the rules on the whole canonical url, each different one once.

Defined cases: null urls and urls without "://" have an empty host and path and fit no rule that has a path; repeated urls
are judged once; rules repeated with the same canonical url count once, block before allow; no rules or no
pages work. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ascii_lower, checkpointed, hot_join

WORDS = 4


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, ascii_lower(F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _block(h: Column, blocks: Column) -> Column:
    return F.pmod(h, blocks)


def _bit(h: Column, word: int) -> Column:
    return F.shiftright(h, 7 + 12 * word).bitwiseAND(F.lit(63)).cast("int")


def bloom_filter(keys: DataFrame, bits_per_key: int = 16, max_bits: int = 1 << 28) -> DataFrame:
    """One row (words) of a filter of the distinct strings in column key.

    It never holds more than max_bits, 32 MB, reached at 16 million keys; beyond, only the share of false hits grows, which the
    join removes.
    """
    n = keys.agg(F.greatest(F.lit(1), F.least(F.lit(max_bits // (64 * WORDS)), F.ceil(F.count("key") * bits_per_key / (64 * WORDS)))).cast("long").alias("blocks"))
    n = checkpointed(n)
    h = F.xxhash64("key")
    hashed = keys.select(_block(h, n.scalar()).alias("block"), h.alias("h"))
    one = F.lit(1).cast("long")
    words = hashed.groupBy("block").agg(*[F.bit_or(F.call_function("shiftleft", one, _bit(F.col("h"), w))).alias(f"w{w}") for w in range(WORDS)])
    every = n.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).join(words, "block", "left")
    rows = F.array_sort(F.collect_list(F.struct("block", F.array(*[F.coalesce(f"w{w}", F.lit(0).cast("long")) for w in range(WORDS)]).alias("words"))))
    return every.agg(F.flatten(F.transform(rows, lambda r: r["words"])).alias("words"))


def might_contain(key: Column, words: Column) -> Column:
    h = F.xxhash64(key)
    at = (_block(h, (F.size(words) / WORDS).cast("long")) * WORDS).cast("int")
    hit = F.lit(True)
    for w in range(WORDS):
        hit = hit & (F.getbit(F.get(words, at + w), _bit(h, w)) == 1)
    return hit


def candidates(host: Column, path: Column, depths: Column, lengths: Column) -> Column:
    """Canonical urls of all rules, with a listed number of labels and a listed path length, that could fit."""
    labels = F.split(host, r"\.", -1)
    hosts = F.transform(F.filter(depths, lambda d: d <= F.size(labels)), lambda d: F.array_join(F.slice(labels, -d, d), "."))
    paths = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.left(path, n))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(F.concat(h, p).alias("key"), h.alias("rule_host")))))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, url) and (host, path, action) -> page_id, host, path, rule, verdict; one row for each input row."""
    listed = checkpointed(
        rules.select(F.coalesce("host", F.lit("")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "action")
        .groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
        .withColumn("key", F.concat("rule_host", "rule_path"))
    )
    words = checkpointed(bloom_filter(listed.select("key").distinct())).scalar()
    sizes = checkpointed(listed.agg(F.array_sort(F.collect_set(F.size(F.split("rule_host", r"\.", -1)))).alias("depths"), F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths")))
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    given = split.select("*", words.alias("words"), sizes.select("depths").scalar().alias("depths"), sizes.select("lengths").scalar().alias("lengths"))
    tried = given.select("page_id", "host", "path", "words", candidates(F.col("host"), F.col("path"), F.col("depths"), F.col("lengths")).alias("tried"))
    probed = tried.select("page_id", "host", "path", F.filter("tried", lambda c: might_contain(c["key"], F.col("words"))).alias("hits"))
    passed = checkpointed(probed.filter(F.size("hits") > 0))
    different = passed.groupBy("host", "path").agg(F.any_value("hits").alias("hits"), F.count("*").alias("n"))
    tests = different.select("host", "path", "n", F.explode("hits").alias("hit")).select("host", "path", "n", "hit.key", "hit.rule_host")
    fits = tests.join(listed, ["key", "rule_host"], "left")
    best = F.max(F.when(F.col("action").isNotNull(), F.struct(F.length("key").alias("size"), F.length("rule_host").alias("host_size"), "key", "action"))).alias("best")
    judged = checkpointed(fits.groupBy("host", "path").agg(F.first("n").alias("n"), best).select(F.struct("host", "path").alias("url"), "n", F.col("best.key").alias("rule"), F.col("best.action").alias("verdict")))
    met = hot_join(passed.select("page_id", F.struct("host", "path").alias("url")), judged, "url").select("page_id", "url.host", "url.path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    rest = probed.filter(F.size("hits") == 0).select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    return met.unionByName(rest)
