"""URL rules answered by a Bloom filter cascade, with DataFrame functions only.

Level 0 encodes the listed keys, level 1 the keys of the corpus that pass level 0 by accident, level 2 the listed keys that
pass level 1, and so on until a level has no false positives.  As the false positives are taken over all keys that the
corpus can ask for, the cascade answers exactly, and no page is joined with the list.  Level 0 is sized by the number of
keys in the corpus, so that its false positives are about as many as the listed keys: every level is a few bits per
*listed* key, whatever the size of the corpus.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftree.llm.common import staged

# The rules of the registered query.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Level:
    bits: DataFrame  # one row, one array of 64-bit words
    size: int
    hashes: int
    salt: int


def split_url(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a null url or one without ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.col("url").substr(at + 3, F.length("url"))).otherwise(F.lit(""))
    return pages.withColumn("__rest", rest).withColumns({
        "host": F.translate(F.regexp_extract("__rest", "^([^/?#]*)", 1), _UPPER, _LOWER),
        "path": F.regexp_extract("__rest", "^[^/?#]*([^?#]*)", 1)}).drop("__rest")


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys that a rule fitting this url can have: host suffixes times path prefixes of the lengths that rules have."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    pairs = F.transform(suffixes, lambda s: F.transform(heads, lambda p: F.struct(F.length(s).alias("h"), F.concat(s, p).alias("key"))))
    return F.array_distinct(F.flatten(pairs))


def _bit(key: Column, i: int, size: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt * 1000 + i)), F.lit(size))


def _hits(key: Column, bits: Column, level: Level) -> Column:
    hit = F.lit(True)
    for i in range(level.hashes):
        at = _bit(key, i, level.size, level.salt)
        word = F.element_at(bits, (F.shiftright(at, 6) + 1).cast("int"))
        hit = hit & (F.getbit(word, (at % 64).cast("int")) == 1)
    return hit


def _build(keys: DataFrame, count: int, rate: float, salt: int) -> Level:
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    words = max(1, math.ceil(count * hashes / math.log(2) / 64))
    size = 64 * words
    at = F.explode(F.array(*[_bit(F.col("key"), i, size, salt) for i in range(hashes)]))
    ones = keys.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("bits"))
    zeros = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    filled = ones.unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    dense = filled.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w")).select(F.col("w.bits").alias("bits"))
    return Level(staged(dense), size, hashes, salt)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    return keys.withColumn("__bits", level.bits.scalar()).where(_hits(F.col("key"), F.col("__bits"), level)).drop("__bits")


def cascade(listed: DataFrame, universe: DataFrame, salt: int = 0, max_levels: int = 60) -> list[Level]:
    """Levels that tell exactly which keys of ``universe`` are ``listed`` (both have a column ``key``)."""
    listed = staged(listed.select("key").distinct())
    n = listed.count()
    if not n:
        return []
    size = universe.agg(F.approx_count_distinct("key", 0.02)).first()[0]
    rate = min(0.5, n / (math.sqrt(2) * max(size, n)))
    levels = [_build(listed, n, rate, salt)]
    inside, outside = listed, None
    while len(levels) < max_levels:
        if len(levels) % 2:  # keys outside the list that pass so far
            passing = _passing(universe.select("key") if outside is None else outside, levels[-1]).distinct()
            outside = passing = staged(passing.join(listed, "key", "left_anti") if outside is None else passing)
        else:
            inside = passing = staged(_passing(inside, levels[-1]))
        n = passing.count()
        if not n:
            return levels
        levels.append(_build(passing, n, 0.5, salt + len(levels)))
    raise ValueError(f"no end after {max_levels} levels")


def member(key: Column, bits: list[Column], levels: list[Level]) -> Column:
    """The first level that a key misses decides: an even one says no, an odd one yes."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        answer = F.when(_hits(key, bits[i], levels[i]), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (or null) and verdict of every page.

    The longest fitting rule decides, of equally long ones the one with the longer host; a url that no rule fits gets
    ``default``: the cascade has shown that none of its keys is listed.  Null urls have no host and no path and fit no rule;
    repeated rows stay; an empty table gives an empty result; other columns of ``pages`` are ignored.
    """
    spark: SparkSession = pages.sparkSession
    lengths = sorted({len(p) for _, _, p in rules})
    urls = split_url(pages.select("page_id", "url"))
    keyed = urls.withColumn("__keys", candidates(F.col("host"), F.col("path"), lengths))
    universe = keyed.select(F.explode("__keys.key").alias("key"))
    listed = spark.createDataFrame([(h + p, v) for v, h, p in rules], "key string, verdict string")
    levels = cascade(listed, universe, 0)
    blocked = cascade(listed.where("verdict = 'block'"), listed, 100)
    out = keyed.withColumns({f"__l{i}": lv.bits.scalar() for i, lv in enumerate(levels)} | {f"__b{i}": lv.bits.scalar() for i, lv in enumerate(blocked)})
    fits = F.filter("__keys", lambda k: member(k["key"], [F.col(f"__l{i}") for i in range(len(levels))], levels))
    best = F.array_max(F.transform(fits, lambda k: F.struct(F.length(k["key"]).alias("n"), k["h"].alias("h"), k["key"].alias("key"))))
    out = out.withColumn("rule", best["key"])
    is_blocked = member(F.col("rule"), [F.col(f"__b{i}") for i in range(len(blocked))], blocked)
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(is_blocked, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


_CASES = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
                  for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {_CASES} END AS rule FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({', '.join(f"'{h}{p}'" for v, h, p in RULES if v == 'block')}) THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
