"""URL rules and a list of unwanted URLs, met through a blocked Bloom filter.

Rules name a host and a path prefix; the longest that fits decides.  Where
none fits, a page is blocked if its canonical URL is listed.  The list may be
far larger than a task: its distinct canonical URLs are hashed into a blocked
Bloom filter of ``BITS_PER_URL`` bits each, so its size follows a count of the
list, and every probe touches one 64-byte block.  The filter is built in parts
of ``PART_BLOCKS`` blocks, each from the hashes that fall into it.  Up to
``BROADCAST_BYTES`` it is sent to every task and pages are probed where they
are read; a larger one stays in its parts, and the pages' distinct hashes are
dealt to them.  Only possible hits go on to the exact join of canonical URLs,
which removes the filter's false positives; clean pages are never shuffled.

A URL that a third of all pages share is one row before the exact join and
meets its answer by broadcast (``join_spread``).

Defined cases: a NULL url, or one without ``://``, has an empty host and path
and fits no rule; a NULL url is never listed; repeated pages give repeated
results; NULL and repeated list entries count once or not at all; rules of one
length go by (host, path) order; an empty list blocks nothing; columns other
than the kept ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from chanmart.llm.common import join_spread, prepare, staged, tidy
from chanmart.llm.revisits import canonical_url

BITS_PER_URL = 12
#: Words of 64 bits in a block: one bit of each is set by a hash.
WORDS = 8
PART_BLOCKS = 1 << 14
BROADCAST_BYTES = 64 << 20
#: Odd multipliers, one a word, drawn from a fixed seed.
MULTIPLIERS = np.random.default_rng(64).integers(0, 1 << 63, WORDS, np.uint64) | np.uint64(1)

#: The query's rules, (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Names of the hosts whose URLs the query's list holds.
LISTED_HOSTS = r"(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\."


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` and the path behind it, both empty without one."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, whole, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, whole, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) of the longest rule that fits, else NULL."""
    rule = verdict = F.lit(None).cast("string")
    for says, at, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(prefix)
        rule = F.when(fits, F.lit(at + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Block number of each 64-bit hash, by its upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def masks(hashes: np.ndarray) -> np.ndarray:
    """(n, WORDS): the bit that each hash sets in each word of its block."""
    return np.uint64(1) << ((hashes[:, None] * MULTIPLIERS) >> np.uint64(58))


def filled(hashes: np.ndarray, first: int, size: int, blocks: int) -> np.ndarray:
    """Blocks ``first`` to ``first + size`` of the filter, from the hashes that fall there."""
    words = np.zeros((size, WORDS), np.uint64)
    np.bitwise_or.at(words, (block_of(hashes, blocks) - np.uint64(first)).astype(np.int64), masks(hashes))
    return words


def may_hold(words: np.ndarray, hashes: np.ndarray, first: int, blocks: int) -> np.ndarray:
    bits = masks(hashes)
    return ((words[(block_of(hashes, blocks) - np.uint64(first)).astype(np.int64)] & bits) == bits).all(axis=1)


def unsigned(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


class BlockedBloom:
    """The parts of a blocked Bloom filter over the ``hash`` column of ``keys`` (distinct hashes)."""

    def __init__(self, keys: DataFrame, bits_per_key: int = BITS_PER_URL, part_blocks: int = PART_BLOCKS):
        self.blocks = max(1, -(-keys.count() * bits_per_key // (64 * WORDS)))
        self.part_blocks = part_blocks
        blocks, size = self.blocks, part_blocks

        def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = key[0].as_py()
            words = np.zeros((size, WORDS), np.uint64)
            for batch in batches:
                words |= filled(unsigned(batch.column("hash")), part * size, size, blocks)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([words.tobytes()], pa.binary())], names=["part", "words"])

        self.parts = staged(
            keys.select("hash", self.part_of(F.col("hash")).alias("part")).groupBy("part").applyInArrow(build, "part long, words binary"),
            "blocked-bloom",
        )

    @property
    def nbytes(self) -> int:
        return self.blocks * WORDS * 8

    def part_of(self, hash_: Column) -> Column:
        """Number of the part that holds a hash's block."""
        high = F.shiftrightunsigned(hash_, 32)
        # Halves of 32 bits: a hash's upper one times the number of blocks stays below 2^63 for 2^31 blocks.
        return F.floor(F.shiftrightunsigned(high * F.lit(self.blocks), 32) / F.lit(self.part_blocks)).cast("long")

    def whole(self) -> np.ndarray:
        """All blocks, for a broadcast: the caller checks ``nbytes`` first."""
        words = np.zeros((self.blocks + self.part_blocks, WORDS), np.uint64)
        for row in self.parts.toLocalIterator():
            at = row["part"] * self.part_blocks
            part = np.frombuffer(bytes(row["words"]), np.uint64).reshape(-1, WORDS)
            words[at : at + len(part)] = part
        return words[: self.blocks]


def _marked_by_broadcast(rows: DataFrame, bloom: BlockedBloom) -> DataFrame:
    """``rows`` with ``suspect``, probed where they are read."""
    sent, blocks = rows.sparkSession.sparkContext.broadcast(bloom.whole()), bloom.blocks

    @tidy
    def probe(batches):
        words = sent.value
        for batch in batches:
            hashes = batch.column("hash")
            known = hashes.is_valid().to_numpy(zero_copy_only=False)
            suspect = np.zeros(batch.num_rows, bool)
            if known.any():
                suspect[known] = may_hold(words, unsigned(hashes.drop_null()), 0, blocks)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(suspect)], names=[*batch.schema.names, "suspect"])

    return rows.mapInArrow(probe, StructType([*rows.schema.fields, StructField("suspect", BooleanType())]))


def _marked_by_parts(rows: DataFrame, bloom: BlockedBloom) -> DataFrame:
    """``rows`` with ``suspect`` where the filter is too large to send: distinct hashes meet the part that holds them."""
    size, blocks = bloom.part_blocks, bloom.blocks
    hashes = rows.filter(F.col("hash").isNotNull()).select("hash").distinct()
    # Pages may outnumber the list: a part's hashes are dealt to slices of about as many as its blocks hold keys.
    slices = max(1, -(-hashes.count() * bloom.part_blocks // (max(bloom.blocks, 1) * PART_BLOCKS * 42)))
    asked = hashes.select("hash", bloom.part_of(F.col("hash")).alias("part"), F.pmod("hash", F.lit(slices)).alias("slice"))
    held = bloom.parts.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")))

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        found = pa.array([], pa.int64())
        if left.num_rows and right.num_rows:
            words = np.frombuffer(right.column("words")[0].as_py(), np.uint64).reshape(-1, WORDS)
            hit = may_hold(words, unsigned(left.column("hash")), left.column("part")[0].as_py() * size, blocks)
            found = left.column("hash").combine_chunks().filter(pa.array(hit))
        return pa.table({"hash": found.cast(pa.int64()) if not isinstance(found, pa.ChunkedArray) else found.combine_chunks()})

    possible = asked.groupBy("part", "slice").cogroup(held.groupBy("part", "slice")).applyInArrow(probe, "hash long")
    marked = join_spread(rows, staged(possible.withColumn("suspect", F.lit(True)), "possible-hits"), "hash")
    return marked.withColumn("suspect", F.coalesce("suspect", F.lit(False)))


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules=RULES,
    keep: tuple[str, ...] = ("page_id",),
    bits_per_url: int = BITS_PER_URL,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row of ``pages`` (``keep`` columns and ``url``): keep, host, path, rule, verdict (``allow`` or ``block``).

    ``listed``: one column ``url``, the unwanted URLs in any form.  ``rules``: at
    most some hundred (verdict, host, path) tuples, compiled into one expression.
    """
    prepare(pages.sparkSession)
    urls = listed.select(canonical_url(F.col("url")).alias("canonical")).filter(F.col("canonical").isNotNull()).distinct()
    urls = staged(urls.withColumn("hash", F.xxhash64("canonical")), "listed-urls")
    bloom = BlockedBloom(urls.select("hash").distinct(), bits_per_url)

    host, path = host_and_path(F.col("url"))
    named = pages.select(*keep, "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = named.select(*keep, "host", "path", rule.alias("rule"), verdict.alias("verdict"), "url")
    judged = judged.withColumn("canonical", F.when(F.col("verdict").isNull(), canonical_url(F.col("url")))).drop("url")
    asked = judged.withColumn("hash", F.when(F.col("canonical").isNotNull(), F.xxhash64("canonical")))
    if bloom.nbytes <= broadcast_bytes:
        marked = _marked_by_broadcast(asked, bloom)
    else:
        marked = _marked_by_parts(staged(asked, "asked-urls"), bloom)
    # A row that can't be listed keeps no key, so it takes no part in the join below.
    key = F.when(F.col("suspect"), F.unhex(F.sha2("canonical", 256)))
    marked = marked.select(*keep, "host", "path", "rule", "verdict", F.when(F.col("suspect"), F.col("canonical")).alias("canonical"), key.alias("key"))
    marked = staged(marked, "marked-urls")

    suspects = marked.filter(F.col("key").isNotNull()).groupBy("key", "canonical").count().drop("count")
    hits = suspects.join(urls.select("canonical"), "canonical", "left_semi").select("key", F.lit(True).alias("listed"))
    found = join_spread(marked, staged(hits, "listed-hits"), "key")
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return found.select(*keep, "host", "path", "rule", F.coalesce("verdict", by_list).alias("verdict"))


def op11_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    listed = pages.filter(host_and_path(F.col("url"))[0].rlike(LISTED_HOSTS)).select("url")
    return filter_urls(pages, listed)


OP11_SQL = r"""
WITH h AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages
), c AS (
  SELECT *, CASE WHEN url IS NOT NULL THEN
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www[0-9]*\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END END AS canonical
  FROM (SELECT *, list_filter(string_split(regexp_extract(b, '^[^?]*\?(.*)$', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)')) AS q
        FROM (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM h))
), rules(says, site, prefix) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT h.page_id, h.url, arg_max(site || prefix, length(site || prefix)) AS rule, arg_max(says, length(site || prefix)) AS says
  FROM h JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix) GROUP BY ALL
)
SELECT c.page_id, host, path, rule,
       coalesce(says, CASE WHEN canonical IN (SELECT canonical FROM c WHERE regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.') AND canonical IS NOT NULL)
                           THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN fits ON fits.page_id IS NOT DISTINCT FROM c.page_id AND fits.url = c.url
"""
