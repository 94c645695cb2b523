"""URL filters: allow and block rules for hosts and path beginnings.

A blocked Bloom filter of the listed rules lets possible hits pass to an exact hash join, which removes its false
positives. DataFrame functions only.

A rule is a host and a path. It fits its host and all subdomains where the URL's path begins with the rule's path. So a
URL is looked up under as many keys as there are shapes among the rules: the last ``labels`` labels of its host with the
first ``length`` characters of its path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.let import let
from tidemark.llm.common import lower_ascii, wrapped

ALLOW, BLOCK = "allow", "block"
# A block is eight words of 64 bits; a key sets one bit in each word of its block.
WORDS = 8
BITS_PER_KEY = 16
# The filter has at most this many blocks (2 MB). Longer lists have more false positives, which the join removes.
MOST_BLOCKS = 1 << 15
# Lists of up to this many rules are broadcast for the join; longer ones are shuffled.
MOST_BROADCAST_RULES = 100_000
SALTS = 16


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """Behind the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table."""
    rows = [F.struct(*[F.lit(v).cast("string").alias(c) for c, v in zip(("host", "path", "verdict"), rule)]) for rule in rules]
    kind = "array<struct<host:string,path:string,verdict:string>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def _key(host: Column, path: Column) -> Column:
    # No host holds a slash, and a path is empty or begins with one.
    return F.concat(host, path)


def listed(rules: DataFrame) -> DataFrame:
    """Canonical rules, each once: key, rule_host, labels, length, verdict.

    Hosts are lower-cased (A-Z), null host or path is empty, a path without a slash in front gets one. Of equal rules a
    ``block`` wins over an ``allow``. A rule with an empty host, or another verdict than the two, is an error.
    """
    path = F.coalesce("path", F.lit(""))
    own = rules.select(lower_ascii(F.coalesce("host", F.lit(""))).alias("rule_host"),
                       F.when((path == "") | path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)).alias("rule_path"),
                       "verdict")
    checked = F.when((F.col("rule_host") != "") & F.coalesce(F.col("verdict").isin(ALLOW, BLOCK), F.lit(False)), F.col("verdict")).otherwise(
        F.raise_error(F.lit("a rule needs a host and the verdict allow or block")))
    return own.groupBy("rule_host", "rule_path").agg(F.max(checked).alias("verdict")).select(
        _key(F.col("rule_host"), F.col("rule_path")).alias("key"), "rule_host",
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("length"), "verdict")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks)).cast("int")


def _bit(h: Column, word: int) -> Column:
    """Which of the 64 bits of a word: six bits of the hash for each word."""
    return F.shiftrightunsigned(h, 6 * word).bitwiseAND(F.lit(63)).cast("int")


def blocks_for(keys: int) -> int:
    """Blocks of a filter of ``keys`` keys: a power of two, at least one."""
    wanted = max(1, -(-keys * BITS_PER_KEY // (64 * WORDS)))
    return min(MOST_BLOCKS, 1 << (wanted - 1).bit_length())


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row: ``words``, the filter's ``8 * blocks`` words of the column ``key``."""
    h = F.xxhash64("key", F.lit(2))
    masks = F.array(*[F.struct((_block(F.col("key"), blocks) * WORDS + w).alias("at"),
                               F.call_function("shiftleft", F.lit(1).cast("long"), _bit(h, w)).alias("mask"))
                      for w in range(WORDS)])
    held = keys.select(F.inline(masks)).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    every = keys.sparkSession.range(0, blocks * WORDS, 1, 1).select(F.col("id").cast("int").alias("at"))
    full = every.join(held, "at", "left").select(F.struct("at", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")).alias("word"))
    return full.agg(F.transform(F.array_sort(F.collect_list("word")), lambda w: w["mask"]).alias("words"))


def maybe_listed(key: Column, words: Column, blocks: int) -> Column:
    """True for every key of the filter, false for most others."""
    def bits(h: Column) -> Column:
        first = _block(key, blocks) * WORDS
        tests = [F.call_function("shiftright", F.get(words, first + w), _bit(h, w)).bitwiseAND(F.lit(1).cast("long")) == 1
                 for w in range(WORDS)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out
    return let(F.xxhash64(key, F.lit(2)), bits)


def judged(pages: DataFrame, rules: DataFrame, otherwise: str = ALLOW) -> DataFrame:
    """One row per row of ``pages``: its columns as ``row``, and host, path, rule, verdict.

    Of the rules that fit a URL the longest (host and path together) wins, of equally long ones the one with the longer
    host. A URL that no rule fits has a null rule and the verdict ``otherwise``: the filter proves that it is not listed,
    or the join does. A null url, or one without ``://``, has an empty host and path and no rule. Repeated rows each get
    their row; the names of the columns of ``pages`` cannot clash. Very long urls are read whole. An empty table of pages
    gives an empty result, an empty table of rules gives ``otherwise`` throughout.

    The number of rules, their shapes (different pairs of labels and path length) and the filter (at most 2 MB) pass
    through the driver and go to the tasks as constants. URLs that the filter stops are not shuffled. The others meet the rules in a hash join: broadcast up to ``MOST_BROADCAST_RULES`` rules, else
    shuffled by key and salt, so that a rule which a third of all URLs fit is spread over ``SALTS`` tasks.
    """
    table = listed(rules)
    n = table.count()
    blocks = blocks_for(n)
    shapes = F.array(*[F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["length"]).alias("length"))
                       for s in sorted(table.select("labels", "length").distinct().collect())]).cast("array<struct<labels:int,length:int>>")
    held = bloom_filter(table, blocks).first()["words"]
    words = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")  # folded to one constant
    rows = pages.select(wrapped(pages), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    def keys(labels: Column) -> Column:
        fitting = F.filter(shapes, lambda s: (s["labels"] <= F.size(labels)) & (s["length"] <= F.length("path")))
        made = F.transform(fitting, lambda s: _key(
            F.array_join(F.slice(labels, F.size(labels) - s["labels"] + 1, s["labels"]), "."),
            F.substring(F.col("path"), F.lit(1), s["length"])))
        return F.filter(made, lambda k: maybe_listed(k, words, blocks))

    probed = rows.withColumn("possible", F.when(F.col("host") != "", let(F.split("host", r"\."), keys)).otherwise(
        F.array().cast("array<string>")))
    stopped = probed.where(F.size("possible") == 0).select(
        "row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))

    passed = probed.where(F.size("possible") > 0).withColumn("id", F.monotonically_increasing_id()).select(
        "id", "row", "host", "path", F.explode("possible").alias("key"))
    known = table.select("key", F.struct(F.length("key").alias("long"), F.length("rule_host").alias("host_long"),
                                         F.col("key").alias("rule"), "verdict").alias("fit"))
    if n <= MOST_BROADCAST_RULES:
        met = passed.join(F.broadcast(known), "key", "left")
    else:
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = passed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(
            salted.hint("shuffle_hash"), ["key", "salt"], "left")
    decided = met.groupBy("id").agg(*[F.any_value(c).alias(c) for c in ("row", "host", "path")], F.max("fit").alias("fit")).select(
        "row", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit(otherwise)).alias("verdict"))
    return stopped.unionByName(decided)


def filter_urls(pages: DataFrame, rules: DataFrame, otherwise: str = ALLOW) -> DataFrame:
    """The rows of ``pages`` with the verdict ``allow``, with all their columns."""
    return judged(pages, rules, otherwise).where(F.col("verdict") == ALLOW).select("row.*")
