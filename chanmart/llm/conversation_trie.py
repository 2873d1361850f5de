"""A trie of conversations' shared beginnings, by blocks of turns first.

Every turn is reduced to a 16-byte digest and its number of code points where
it is read, so only narrow rows are shuffled.  A conversation's digests are
chained in order (a stream, one conversation after another), and after every
``BLOCK_TURNS`` turns the chain names the whole beginning up to there.
Conversations are grouped by these block digests: an aggregate, so thousands
of copies are one row a task before the shuffle.  Turn boundaries are looked
at only in blocks that have siblings, i.e. whose parent goes on in more than
one way: there the block's turns are chained one by one and grouped again.  A
block without siblings is a chain of turns with the same members and is
written out from its one row.

A subtree's sums need no walk over levels.  A node belongs to its smallest
member; along a conversation the nodes it owns are its last ones.  Let z be
the code points of a conversation before the first node it owns (all of them,
if it owns none).  Then the tokens saved below a node at depth d with n members
and smallest member r are  sum(z of members) - z(r) - (n - 1) * (code points
before depth d),  and its leaves are the members that own the childless node
they end in.  Both are sums over members, taken by blocks as above.

Where a lookup goes by a parent's digest, of which one (the root) may hold a
third of all rows, hot keys meet by broadcast (``join_spread``).

Defined cases: rows without conversation id take no part; NULL roles and texts
are empty; NULL turns come first; turns of one number are ordered by the
digest of role and text, repeated rows are repeated turns; a conversation
without turns is a member of the root alone; an empty table has no nodes.
Digests are 128 bits of SHA-256.  A conversation's own turns are one stream
through one task, in bounded memory.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chanmart.llm.common import join_spread, prepare, staged, tidy

BLOCK_TURNS = 4
#: Conversations of one hundred share turns of the first of them: at most so many.
MAX_HEAD = 5
SHARING = 100
ROOT = bytes(16)
OUT_ROWS = 1000

TURN = "struct<digest:binary,chars:long>"
BLOCKS = f"conv_id long, depth long, parent binary, own binary, chars_before long, turns array<{TURN}>, is_end boolean, chars_total long"
NODES = "own binary, key binary, parent binary, depth long, chars_before long, inner boolean"
_TURN = pa.list_(pa.struct([("digest", pa.binary()), ("chars", pa.int64())]))


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that tell (role, text) pairs apart."""
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text), 256)
    return F.unhex(F.substring(whole, 1, 32))


def chained(before: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(before + turn).digest()[:16]


def narrow_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, chars) of every turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"), F.char_length(text).cast("long").alias("chars")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.withColumn("place", F.row_number().over(order).cast("long")).drop("turn")


def shared_heads(turns: DataFrame) -> DataFrame:
    """The query's rebuilt conversations, (conv_id, place, digest, chars) and one row without digest a conversation.

    A conversation c begins with the first h = crc32(c) % 6 turns of
    conversation c - c % 100 and goes on with its own turns after its first h.
    """
    head = (F.crc32(F.col("conv_id").cast("string")) % (MAX_HEAD + 1)).cast("long")
    convs = turns.select("conv_id").distinct()
    lenders = turns.filter((F.col("conv_id") % SHARING == 0) & (F.col("place") <= MAX_HEAD)).withColumnRenamed("conv_id", "lender")
    asking = convs.withColumns({"lender": F.col("conv_id") - F.col("conv_id") % SHARING, "head": head})
    lent = asking.join(lenders, "lender").filter(F.col("place") <= F.col("head")).select("conv_id", (F.col("place") - MAX_HEAD - 1).alias("place"), "digest", "chars")
    own = turns.filter(F.col("place") > head).select("conv_id", "place", "digest", "chars")
    none = convs.select("conv_id", F.lit(-MAX_HEAD - 2).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return own.unionByName(lent).unionByName(none)


def blocks_of(turns: DataFrame, block_turns: int) -> DataFrame:
    """``BLOCKS`` rows of each conversation's turns in order of ``place``; rows without digest are no turns."""

    @tidy
    def run(batches):
        out, conv, block = [], None, None
        for batch in batches:
            for c, _, digest, chars in zip(*(x.to_pylist() for x in batch.columns)):
                if c != conv:
                    if block is not None:
                        out.append((*block[:6], True, total))
                    conv, total, own, depth = c, 0, ROOT, 0
                    block = [c, 0, None, ROOT, 0, []]
                if digest is None:
                    continue
                if not block[5] or len(block[5]) == block_turns:
                    # A root block without turns is replaced, a full one goes out now that it isn't the last.
                    if block[5]:
                        out.append((*block, False, None))
                    block = [c, depth, own, None, total, []]
                own, depth, total = chained(own, digest), depth + 1, total + chars
                block[5].append({"digest": digest, "chars": chars})
                block[3] = own
                if len(out) >= OUT_ROWS:
                    yield _block_batch(out)
                    out = []
        if block is not None:
            out.append((*block[:6], True, total))
        if out:
            yield _block_batch(out)

    dealt = turns.select("conv_id", "place", "digest", "chars").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.mapInArrow(run, BLOCKS)


def _block_batch(rows):
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), _TURN, pa.bool_(), pa.int64()]
    names = ["conv_id", "depth", "parent", "own", "chars_before", "turns", "is_end", "chars_total"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def turns_of_blocks(blocks: DataFrame) -> DataFrame:
    """A ``NODES`` row for each turn of each distinct block; ``divergent`` blocks' turns are keyed, others' only at the ends."""

    @tidy
    def run(batches):
        for batch in batches:
            out = []
            for own, parent, depth, before, turns, divergent in zip(*(c.to_pylist() for c in batch.columns)):
                key = parent
                for i, turn in enumerate(turns):
                    above, last = key, i == len(turns) - 1
                    if divergent:
                        key = chained(above, turn["digest"])
                    else:
                        key = own if last else None
                    out.append((own, key, above, depth + i + 1, before, not divergent and not last))
                    before += turn["chars"]
            types = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
            columns = list(zip(*out)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["own", "key", "parent", "depth", "chars_before", "inner"])

    return blocks.select("own", "parent", "depth", "chars_before", "turns", "divergent").mapInArrow(run, NODES)


def _refined(nodes: DataFrame, sums: DataFrame, totals: dict[str, Column], whole: DataFrame) -> DataFrame:
    """Nodes with their members' sums: keyed turns of sibling blocks are grouped once more; ``whole`` is the root's row."""
    rows = nodes.join(sums, "own")
    fixed = ["depth", "chars_before"]
    alike = rows.filter("divergent").groupBy("key").agg(*(F.any_value(c).alias(c) for c in ("parent", *fixed)), *(c.alias(n) for n, c in totals.items()), F.lit(False).alias("inner"))
    alone = rows.filter("NOT divergent").select("key", "parent", *fixed, *totals, "inner")
    return alike.unionByName(alone).unionByName(whole)


def _digests_of_ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): of the conversations that end at a node, by number, as a stream."""

    @tidy
    def run(batches):
        out, key, digest = [], None, None
        for batch in batches:
            for own, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key:
                    if digest is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            if len(out) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in ((0, pa.binary()), (1, pa.string()))], names=["key", "ends_sha256"])
                out = []
        if digest is not None:
            out.append((key, digest.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in ((0, pa.binary()), (1, pa.string()))], names=["key", "ends_sha256"])

    dealt = ends.select("own", "conv_id").repartition("own").sortWithinPartitions("own", "conv_id")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Per distinct beginning: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: conv_id (long), place (its order), digest (NULL: no turn, the
    conversation exists all the same), chars; see ``narrow_turns``.
    """
    prepare(turns.sparkSession)
    blocks = staged(blocks_of(turns, block_turns), "trie-blocks")
    ends = blocks.filter("is_end")
    grouped = blocks.filter(F.size("turns") > 0).groupBy("own").agg(*(F.any_value(c).alias(c) for c in ("parent", "depth", "chars_before", "turns")), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    distinct = staged(grouped, "trie-distinct-blocks")
    siblings = distinct.groupBy("parent").agg((F.count(F.lit(1)) > 1).alias("divergent"))
    marked = staged(join_spread(distinct, staged(siblings, "trie-siblings"), "parent"), "trie-marked-blocks")
    nodes = staged(turns_of_blocks(marked), "trie-turns")

    # Owners: the nodes whose smallest member a conversation is.
    root = F.lit(bytearray(ROOT))
    whole = {"key": root, "parent": F.lit(None).cast("binary"), "depth": F.lit(0).cast("long"), "chars_before": F.lit(0).cast("long"), "inner": F.lit(False)}

    def of_root(frame, **totals):
        # A group, not a bare aggregate: no conversations, no root.
        return frame.groupBy(root.alias("key")).agg(*(c.alias(n) for n, c in {**{k: v for k, v in whole.items() if k != "key"}, **totals}.items()))

    owners = _refined(
        nodes, marked.select("own", "divergent", "n", "first"), {"n": F.sum("n"), "first": F.min("first")}, of_root(ends, n=F.count(F.lit(1)), first=F.min("conv_id"))
    )
    owners = staged(owners, "trie-owners")
    ended = ends.groupBy("own").agg(F.count(F.lit(1)).alias("ended")).withColumnRenamed("own", "key")
    leaf = owners.join(ended, "key").filter(F.col("n") == F.col("ended")).select(F.col("first").alias("conv_id"), F.lit(1).cast("long").alias("leaf"))
    tops = owners.select(F.col("first").alias("conv_id"), F.col("chars_before").alias("z"), F.col("depth").alias("top"))
    unowned = ends.select("conv_id", F.col("chars_total").alias("total"))
    facts = tops.unionByName(leaf, allowMissingColumns=True).unionByName(unowned, allowMissingColumns=True)
    facts = facts.groupBy("conv_id").agg(F.coalesce(F.min("z"), F.max("total")).alias("z"), F.coalesce(F.max("leaf"), F.lit(0)).alias("leaf"), F.min("top").alias("top"))
    facts = staged(facts, "trie-conversations")

    # Sums over members, by blocks and then by the turns of sibling blocks.
    members = join_spread(staged(blocks.select("conv_id", "own"), "trie-members"), facts, "conv_id")
    least = F.struct("conv_id", "z", "top")
    in_blocks = members.filter(F.col("own") != root).groupBy("own").agg(F.sum("z").alias("z"), F.sum("leaf").alias("leaves"), F.min(least).alias("least"), F.count(F.lit(1)).alias("n"))
    sums = in_blocks.join(marked.select("own", "divergent"), "own")
    everyone = of_root(facts, z=F.sum("z"), leaves=F.sum("leaf"), least=F.min(least), n=F.count(F.lit(1)))
    totals = {"z": F.sum("z"), "leaves": F.sum("leaves"), "least": F.min("least"), "n": F.sum("n")}
    full = staged(_refined(nodes, sums, totals, everyone), "trie-nodes")

    # Turns inside a block without siblings have one child each and no ends.
    keyed = full.filter("NOT inner")
    children = full.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("children"))
    known = keyed.join(children, "key", "left").join(_digests_of_ends(ends), "key", "left")
    all_nodes = known.unionByName(full.filter("inner"), allowMissingColumns=True)
    empty = hashlib.sha256(b"").hexdigest()
    at_top = F.col("depth") == F.col("least.top")
    result = all_nodes.select(
        F.col("least.conv_id").alias("conv_id"),
        "depth",
        F.when(at_top, F.col("parent")).alias("parent"),
        F.when(~at_top, F.col("least.conv_id")).alias("same_parent"),
        F.col("n").alias("n_convs"),
        F.when(F.col("inner"), 1).otherwise(F.coalesce("children", F.lit(0))).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("z") - F.col("least.z") - (F.col("n") - 1) * F.col("chars_before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
    result = staged(result, "trie-result")
    parents = keyed.select(F.col("key").alias("parent"), F.col("least.conv_id").alias("other_parent"))
    return join_spread(result, parents, "parent").select(
        "conv_id", "depth", F.coalesce("same_parent", "other_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = staged(narrow_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")), "trie-narrow-turns")
    return prefix_trie(shared_heads(turns))


def _oracle() -> str:
    """The same trie by joins: beginnings as texts of digests, and every node met with all nodes above it."""
    from chanmart.llm.conversation_repair import CRC32_SQL

    return f"""
WITH t AS (
  SELECT conv_id, turn, sha256(length(r) || ':' || r || ':' || x) AS d, length(x) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(length(r) || ':' || r || ':' || x), 1, 32)) AS place
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, {CRC32_SQL} % 6 AS h FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM t)
), m AS (
  SELECT c.conv_id, t.place - 6 AS place, d, n FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.place <= h
  UNION ALL SELECT t.conv_id, place, d, n FROM t JOIN c ON c.conv_id = t.conv_id AND t.place > h
), path AS (
  SELECT conv_id, row_number() OVER w AS depth, md5(string_agg(d, '') OVER w) AS node, n FROM m
  WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, md5(''), 0 FROM c
), up AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, max(depth) OVER (PARTITION BY conv_id) = depth AS is_end FROM path
), node AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM up GROUP BY node
), kids AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY 1),
below AS (
  SELECT a.node, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((v.n_convs - 1) * v.n) AS saved_tokens
  FROM node v LEFT JOIN kids k ON k.node = v.node JOIN path a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.node
)
SELECT node.conv_id, node.depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN node p ON p.node = node.parent
"""


OP13_SQL = _oracle()
