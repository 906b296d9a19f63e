"""URL filter: a blocked Bloom filter in front of an exact hash join.

The list holds rules ``(host, path)`` that fit a host, its subdomains and every
path starting with the rule's, and single canonical URLs. Every URL has a few
keys under which the list might hold it. The Bloom filter of all listed keys
passes the keys that may be listed, each by one 64-byte block; only those meet
the list in a hash join, which removes the false positives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import ascii_lower, join_spread, let_workers_import, stored

BLOCK_BITS, BLOCK_WORDS, PROBES = 512, 8, 6
ALLOW, BLOCK = "allow", "block"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` and path without trailing slashes."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def site_host(host: Column) -> Column:
    """The site a host belongs to: without a leading ``www.``, ``m.`` or ``blog.``."""
    return F.regexp_replace(host, r"^(www|m|blog)\.", "")


def _rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("r"), host, F.lit(" "), path)


def listing(rules: DataFrame | None, urls: DataFrame | None, sites: DataFrame | None = None) -> DataFrame:
    """The list as ``key, rule, rank, verdict``: rules ``(host, path, verdict)``,
    the distinct non-null blocked ``canonical`` URLs, and the distinct non-null
    blocked ``site`` hosts, which stand for their subdomains too."""
    parts = []
    if rules is not None:
        host, path = ascii_lower(F.col("host")), F.col("path")
        parts.append(rules.select(_rule_key(host, path).alias("key"), F.concat(host, path).alias("rule"),
                                  F.struct(F.length(F.concat(host, path)).alias("chars"),
                                           F.length(host).alias("host_chars")).alias("rank"), "verdict"))
    for single, name, mark, place in ((urls, "canonical", "u", -1), (sites, "site", "h", -2)):
        if single is not None:
            parts.append(single.where(F.col(name).isNotNull()).select(name).distinct().select(
                F.concat(F.lit(mark), F.col(name)).alias("key"), F.lit(None).cast("string").alias("rule"),
                F.struct(F.lit(place).alias("chars"), F.lit(place).alias("host_chars")).alias("rank"),
                F.lit(BLOCK).alias("verdict")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key), F.xxhash64(F.lit(1), key)]


class BlockedBloom:
    """Blocks of 512 bits; a key's first hash picks the block, 9-bit fields of
    the second its bits. The size follows the list up to ``max_bytes``; beyond
    that more false positives pass on to the exact join, nothing is missed."""

    def __init__(self, keys: DataFrame, bits_per_key: int = 12, max_bytes: int = 32 << 20):
        n = keys.count()
        self.blocks = int(max(1, min(-(-n * bits_per_key // BLOCK_BITS), max_bytes * 8 // BLOCK_BITS)))
        h1, h2 = _hashes(F.col("key"))
        hashed = keys.select(F.pmod(h1, F.lit(self.blocks)).alias("block"), h2.alias("h"))
        words = []
        for w in range(BLOCK_WORDS):
            word = F.lit(0).cast("long")
            for j in range(PROBES):
                bit = F.shiftright("h", 9 * j).bitwiseAND(F.lit(BLOCK_BITS - 1))
                own = F.when(F.shiftright(bit, 6) == w, F.expr(f"shiftleft(1L, cast((shiftright(h, {9 * j}) & 63) as int))"))
                word = word.bitwiseOR(F.coalesce(own, F.lit(0).cast("long")))
            words.append(F.bit_or(word).alias(f"w{w}"))
        # At most max_bytes / 64 rows, whatever the list's size.
        rows = hashed.groupBy("block").agg(*words).toArrow()
        self.words = np.zeros((self.blocks, BLOCK_WORDS), dtype=np.uint64)
        at = rows.column("block").to_numpy()
        for w in range(BLOCK_WORDS):
            self.words[at, w] = rows.column(f"w{w}").to_numpy().view(np.uint64)

    def may_hold(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        block = np.mod(h1, self.blocks)
        found = np.ones(len(h1), dtype=bool)
        for j in range(PROBES):
            bit = (h2 >> (9 * j)) & (BLOCK_BITS - 1)
            word = self.words[block, bit >> 6]
            found &= (word >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return found


def _candidate_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    labels = F.split(host, r"\.", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels) - i + 1), "."))
    lengths = F.array(*[F.lit(n) for n in path_lengths]).cast("array<int>")
    starts = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    prefixes = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda p: _rule_key(h, p))))
    sites = F.transform(F.filter(hosts, lambda h: h != ""), lambda h: F.concat(F.lit("h"), h))
    return F.concat(prefixes, sites, F.array(F.concat(F.lit("u"), canonical(host, path))))


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
                bits_per_key: int = 12) -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict, listed, decided_by``.

    The longest fitting rule decides (of equal ones, that of the longest host);
    without a rule, a URL is blocked if its canonical form is listed, or a site
    that its host belongs to, else allowed. ``listed`` says whether the exact join
    found anything, ``decided_by`` what (``rule``, ``url``, ``site`` or null).

    Rows that pass the Bloom filter under no key are final where they are
    scanned; only the others are joined and shuffled.

    A null URL or one without ``://`` has an empty host and path and fits no
    rule. Ids may be null or repeated; every row gets its row. An empty table or
    list gives no rows, or allows everything. Other columns are not read. If a
    rule is given twice with both verdicts, ``block`` wins.
    """
    let_workers_import(pages.sparkSession)
    bloom = BlockedBloom(listed.select("key"), bits_per_key)
    # One number per distinct rule length: bounded by the longest rule.
    rule_paths = listed.where(F.col("rule").isNotNull()).select(
        (F.col("rank.chars") - F.col("rank.host_chars")).alias("n")).distinct().collect()
    lengths = sorted(r["n"] for r in rule_paths)
    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    keyed = parts.withColumn("keys", _candidate_keys(F.col("host"), F.col("path"), lengths))
    hashed = keyed.select("*", F.transform("keys", lambda k: _hashes(k)[0]).alias("h1"),
                          F.transform("keys", lambda k: _hashes(k)[1]).alias("h2"))
    id_type = dict(parts.dtypes)["page_id"]

    def run(batches):
        for batch in batches:
            keys = batch.column(3)
            held = bloom.may_hold(*(batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (4, 5)))
            offsets = np.concatenate([[0], np.cumsum(held)])[keys.offsets.to_numpy() - keys.offsets[0].as_py()]
            hits = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), keys.flatten().filter(pa.array(held)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], hits], names=["page_id", "host", "path", "keys"])

    possible = stored(hashed.mapInArrow(run, f"page_id {id_type}, host string, path string, keys array<string>"), "url-keys")
    free = possible.where(F.size("keys") == 0).select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(ALLOW).alias("verdict"),
        F.lit(False).alias("listed"), F.lit(None).cast("string").alias("decided_by"))
    rows = (possible.where(F.size("keys") > 0).withColumn("row", F.monotonically_increasing_id())
            .select("row", "page_id", "host", "path", F.explode("keys").alias("key")))
    exact = join_spread(rows, listed, ["key"], "row", "left")
    best = F.max(F.when(F.col("verdict").isNotNull(),
                        F.struct("rank.chars", "rank.host_chars", "verdict", "rule"))).alias("best")
    decided = F.when(F.col("best.chars") >= 0, "rule").when(F.col("best.chars") == -1, "url").when(F.col("best.chars") == -2, "site")
    judged = exact.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"),
                                    F.first("path").alias("path"), best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"), F.col("best").isNotNull().alias("listed"),
        decided.alias("decided_by"))
    return free.unionByName(judged)


#: The rules of the registered query (host, path, verdict).
RULES = (("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK),
         ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK))
#: The registered query's list holds what was met under these site names over this scheme;
#: pages met otherwise are for the list to decide.
LISTED_SITES = r"(^|\.)(spam-farm|cheap-pills|casino-win|ads-track|free-bets|adult-x)\."
LISTED_SCHEME = "https:"

ORACLE = r"""
WITH parts AS (
  SELECT page_id, starts_with(url, 'https:') AS source, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS canonical,
    regexp_replace(host, '^(www|m|blog)\.', '') AS site
  FROM parts),
listed AS (
  SELECT canonical, site FROM ruled
  WHERE source AND regexp_matches(host, '(^|\.)(spam-farm|cheap-pills|casino-win|ads-track|free-bets|adult-x)\.')),
sites AS (SELECT DISTINCT page_id FROM parts JOIN (SELECT DISTINCT site FROM listed) s ON ends_with('.' || host, '.' || s.site)),
decided AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN 'rule' WHEN canonical IN (SELECT canonical FROM listed) THEN 'url'
    WHEN page_id IN (SELECT page_id FROM sites) THEN 'site' END AS decided_by FROM ruled)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN decided_by IS NULL THEN 'allow' ELSE 'block' END AS verdict,
  decided_by IS NOT NULL AS listed, decided_by
FROM decided
"""
