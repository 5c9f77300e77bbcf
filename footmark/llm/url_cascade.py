"""URL rules by a cascade of Bloom filters, with DataFrame functions only.

A rule is a host and a path; its key is both written together (``example.com/en/``). The keys that
could judge a url are known beforehand: a suffix of its host (at label boundaries) and a beginning of
its path. All such keys of all urls are the corpus's key universe. The first filter of a cascade
encodes the listed keys; the unlisted keys of the universe that it lets pass are encoded by the second
filter, the listed keys that this one lets pass by the third, and so on until none passes. Over the
universe the answer is exact: a key is listed if the first filter that stops it is the second, fourth
and so on, or if none stops it and their number is odd. So urls are judged in one map over the pages, with the
filters' bits as literals: no join, no shuffle.

Plan: the universe is one aggregation over the candidate keys and the rules (a hot key such as ``com/``
is reduced before the shuffle), which also marks the listed keys; a level writes only the keys that it
wrongly lets pass, about half as many as the level before. Two cascades are built: listed keys among
all, and blocked keys among the listed ones. The bits depend on the number of listed keys that occur
and on the logarithm of the universe. Above MAX_BITS the keys are dealt by hash into parts with a
cascade each, and the pages are judged by one part after the other; so no literal is larger.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footmark.llm.common import cut, prepare, quoted, unused

#: Rules of the registered query: action, host, path. Fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Verdict of a url that no listed key fits.
UNLISTED = "allow"
#: Bits of one cascade (4 MB); more are split into parts by key hash.
MAX_BITS = 1 << 25
#: Bits of one bitmap that Spark's bitmap aggregate makes.
BUCKET = 32768
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Level:
    """One Bloom filter: ``bits`` bits in ``data``, ``probes`` bits a key."""

    def __init__(self, salt: int, bits: int, probes: int):
        self.salt, self.bits, self.probes, self.data = salt, bits, probes, F.lit(b"")

    def positions(self, key: Column) -> list[Column]:
        """Bit positions by double hashing. The salt comes first, so that keys which agree in one
        level's 64-bit hash differ in the next one's."""
        a = F.pmod(F.xxhash64(F.lit(2 * self.salt), key), F.lit(self.bits))
        b = F.pmod(F.xxhash64(F.lit(2 * self.salt + 1), key), F.lit(self.bits))
        return [F.pmod(a + F.lit(i) * b + F.lit(i * i), F.lit(self.bits)) if i else a for i in range(self.probes)]

    def fill(self, keys: DataFrame) -> None:
        """Set the bits of ``keys``; the driver gets the bitmaps, ``bits`` bits together."""
        at = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("at"))
        maps = at.groupBy(F.floor(F.col("at") / BUCKET).alias("bucket")) \
            .agg(F.bitmap_construct_agg(F.pmod("at", F.lit(BUCKET))).alias("bits")).collect()
        found = {r["bucket"]: bytes(r["bits"]) for r in maps}
        whole = b"".join(found.get(b, bytes(BUCKET // 8)) for b in range(-(-self.bits // BUCKET)))
        self.data = F.lit(whole[:-(-self.bits // 8)])

    def contains(self, key: Column) -> Column:
        out = F.lit(True)
        for at in self.positions(key):
            byte = F.ascii(F.decode(F.substring(self.data, (F.floor(at / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
            out = out & (F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1)
        return out


class Cascade:
    """Exact membership over a universe of keys. A level encodes the keys that are left on one side;
    ``rest`` tells whether any are left after the last level, which then are all that got so far."""

    def __init__(self, levels: list[Level], rest: bool):
        self.levels, self.rest = levels, rest

    def contains(self, key: Column) -> Column:
        out = F.lit(self.rest)
        for level in reversed(self.levels):
            out = level.contains(key) & ~out
        return out


def sizes(n_in: int, n_out: int, first: bool) -> tuple[int, int]:
    """(bits, probes): the first level lets about n_in / sqrt(2) unlisted keys pass, later ones half."""
    rate = min(0.5, n_in * math.sqrt(0.5) / max(n_out, 1)) if first else 0.5
    probes = max(1, round(math.log2(1 / rate)))
    return max(64, math.ceil(n_in * probes / math.log(2))), probes


def build(universe: DataFrame, salt: int = 0) -> Cascade:
    """The cascade of a written table (key string, listed boolean), one row a key."""
    n = {r["listed"]: r["n"] for r in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    inside, outside = (universe.filter(F.col("listed") == x).select("key") for x in (True, False))
    n_in, n_out, levels = n.get(True, 0), n.get(False, 0), []
    while n_in and n_out:
        level = Level(salt + len(levels), *sizes(n_in, n_out, not levels))
        level.fill(inside)
        levels.append(level)
        wrong = cut(outside.filter(level.contains(F.col("key"))), "cascade")
        inside, outside, n_in, n_out = wrong, inside, wrong.count(), n_in
    return Cascade(levels, bool(n_in))


def parse(url: Column) -> tuple[Column, Column]:
    """(host, path): the host follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; the path
    goes on from there up to ``? #``. Both are empty without ``://`` and for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidates(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Keys that could judge a url, the longest first (of equal ones the longer host first): host
    suffixes of at most ``labels`` labels with beginnings of the path of the given lengths."""
    parts = F.split(host, r"\.", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
                        lambda i: F.array_join(F.slice(parts, -i, i), "."))
    hosts = F.filter(hosts, lambda h: h != "")
    heads = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(heads, lambda n: F.transform(
        hosts, lambda h: F.struct((-F.length(h) - n).alias("whole"), (-F.length(h)).alias("host"),
                                  F.concat(h, F.substring(path, F.lit(1), n)).alias("key")))))
    return F.transform(F.array_sort(keys), lambda x: x["key"])


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules])
    return spark.range(1).select(F.inline(rows))


def key_universe(urls: DataFrame, rules: DataFrame) -> tuple[DataFrame, int, list[int]]:
    """From urls (host, path): (one row per key of the corpus with ``listed`` and ``blocked``, most
    labels of a rule's host, the lengths of the rules' paths)."""
    rules = rules.select("action", F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path")) \
        .filter(F.col("action").isin("allow", "block") & F.col("host").rlike(r"^[^/?#]+\z") & F.col("path").rlike(r"^(/[^?#]*)?\z"))
    shape = rules.agg(F.max(F.size(F.split("host", r"\.", -1))).alias("labels"),
                      F.array_sort(F.collect_set(F.length("path"))).alias("lengths")).first()
    labels, lengths = shape["labels"] or 0, list(shape["lengths"])
    keys = rules.select(F.concat("host", "path").alias("key"), F.lit(True).alias("rule"), (F.col("action") == "block").alias("blocked"))
    if lengths:
        seen = urls.select(F.explode(candidates(F.col("host"), F.col("path"), labels, lengths)).alias("key"))
        keys = keys.unionByName(seen.select("key", F.lit(False).alias("rule"), F.lit(False).alias("blocked")))
    keys = keys.groupBy("key").agg(F.max("rule").alias("listed"), F.max("blocked").alias("blocked"), F.max(~F.col("rule")).alias("occurs"))
    return cut(keys.filter("occurs").drop("occurs"), "universe"), labels, lengths


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` with host, path, rule (the key of the longest rule that fits, else null) and verdict.

    A rule (action allow or block, host, path) fits its host and all subdomains if the url's path
    starts with the rule's path; the longest host and path together wins, of equal lengths the longer
    host. Of two actions for one key, block wins. Rules that can fit no url (another action, no host,
    a path that is neither empty nor begins with a slash) are left out; a null path of a rule is the
    empty one. A null url, or one without ``://``, has an empty host and path and no rule; urls that
    no rule fits aren't listed and get ``UNLISTED``. Long urls are read whole: only host suffixes with
    as many labels as a rule has can be keys, so a host of many dots stays linear. Repeated rows are
    judged each; columns of ``pages`` named like a result are replaced by it. An empty table gives no
    rows, no rules give ``UNLISTED`` for all."""
    prepare(pages.sparkSession)
    host, path = parse(F.col(quoted(url_col)))
    keys, labels, lengths = key_universe(pages.select(host.alias("host"), path.alias("path")), rules)
    kept = [F.col(quoted(c)) for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    found, best = unused("found", pages.columns), unused("best", pages.columns)
    out = pages.select(*kept, host.alias("host"), path.alias("path"),
                       F.lit(None).cast("struct<whole: int, host: int, rule: string, verdict: string>").alias(best))
    n = keys.agg(F.count_if("listed").alias("listed"), F.count("*").alias("n")).first()
    # later levels hold about as many keys as the list together, two bits a key
    bits = sizes(n["listed"], n["n"] - n["listed"], True)[0] + 4 * n["listed"] if n["listed"] else 0
    parts = -(-bits // max_bits)
    if parts > 1:
        keys = cut(keys.withColumn("part", _part(F.col("key"), parts)), "parts")
    for p in range(parts):
        some = keys.filter(F.col("part") == p) if parts > 1 else keys
        listed = build(some.select("key", "listed"))
        blocked = build(some.filter("listed").select("key", F.col("blocked").alias("listed")), salt=1000)
        fits = _fits(listed, p, parts)
        own = candidates(F.col("host"), F.col("path"), labels, lengths)
        rule = F.col(found)
        verdict = F.when(blocked.contains(rule), "block").otherwise("allow")
        of_part = F.when(rule.isNotNull(), F.struct(F.length(rule).alias("whole"), F.length(F.substring_index(rule, "/", 1)).alias("host"),
                                                    rule.alias("rule"), verdict.alias("verdict")))
        out = out.withColumn(found, F.get(F.filter(own, fits), F.lit(0))) \
            .withColumn(best, F.greatest(F.col(best), of_part)).drop(found)
        if p + 1 < parts:
            out = cut(out, "judged")
    return out.select(*kept, "host", "path", F.col(best)["rule"].alias("rule"),
                      F.coalesce(F.col(best)["verdict"], F.lit(UNLISTED)).alias("verdict"))


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(parts))


def _fits(listed: Cascade, part: int, parts: int):
    return lambda key: listed.contains(key) if parts == 1 else (_part(key, parts) == part) & listed.contains(key)
