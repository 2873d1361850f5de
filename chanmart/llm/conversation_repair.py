"""Repair of conversations by a survivor-coalescing Viterbi search.

A conversation's turns are edited (kept, given another role, deleted, or a
turn inserted) so that its roles read system?(user assistant)+, or nothing is
left, at the least cost.  The search walks the turns once and keeps, for each
of the four states (nothing yet, after system, after user, after assistant),
the cheapest way to be there.  Ways share their beginnings in a tree of back
pointers whose nodes count their children and the states that stand on them;
a way that loses is freed back to where another one still needs it.  As soon
as all ways share their first edits, these are emitted and forgotten, so a
conversation of any length takes the memory of its unresolved end alone.  Of
two equally cheap ways the one whose edits' initials come first in ASCII order
wins: both are followed back to where they part, however far that is, and the
edits there decide.  (Ways to one state never end as prefixes of each other:
edits say which state comes next, so the longer one would cost more.)  Two
states can be given up early, since "after assistant" can do whatever they
can: "after system" once it is behind, and "nothing yet" once it is behind by
more than the one system turn that it could still keep.

Turns are dealt by conversation and sorted within tasks, which spills; a
conversation is a stream, never a group in memory, even where it holds a third
of all rows.  It can't be split over tasks, since its digest of the repaired
text is one sequence.

Defined cases: NULL roles and texts count as one space (so such a turn is
blank, or has a role that is none of the three); NULL conversation ids are one
conversation; NULL turns come first; turns of one number are ordered by role
and text, and of equal ones the first counts as seen earlier; an empty table
gives no rows; a conversation without rows after damage gets zeros, an empty
audit and the hash of nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chanmart.llm.common import prepare, tidy

#: Costs of the edits, and what a truncated turn adds where it stays.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: What counts as white space at the ends of a text.
BLANKS = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a turn whose role begins with this letter; a state without the letter can't take the turn.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
LEGAL_PAIRS = frozenset(("su", "ua", "au"))
ROLE = {USER: "user", ASSISTANT: "assistant"}
OUT_ROWS = 2000


def faulted(turns: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, role, text, present, fault (0 none, 1 to 3 as in ``FAULTS``), place among its equals.

    ``turns`` has a boolean ``present``; a row that isn't only says that its
    conversation exists.  Dealt by conversation; the window for repeats runs
    in the same partitions.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    there = F.coalesce("present", F.lit(True))
    dealt = turns.select("conv_id", "turn", F.when(there, role).otherwise("").alias("role"), F.when(there, text).otherwise("").alias("text"), there.alias("present"))
    dealt = dealt.repartition("conv_id")
    same = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    order = F.col("turn").asc_nulls_first()
    place = F.row_number().over(Window.partitionBy("conv_id", "present", "same").orderBy(order))
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(trimmed == "", 1).when(F.col("place") > 1, 2).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    )
    ranked = dealt.withColumn("same", same).withColumn("place", place)
    return ranked.select("conv_id", "turn", "role", "text", "present", fault.cast("int").alias("fault"), "place")


class _Edit:
    """A node of the back-pointer tree: one edit, with the edits that follow it and the states that stand on it."""

    __slots__ = ("before", "initial", "role", "text", "length", "after", "heads")

    def __init__(self, before, initial, role=None, text=None):
        self.before, self.initial, self.role, self.text = before, initial, role, text
        self.length = before.length + 1 if before is not None else 0
        self.after, self.heads = [], 0


def _less(a: _Edit, b: _Edit) -> bool:
    """Whether the edits up to ``a`` come before those up to ``b``, from where the two part."""
    longer = a.length > b.length
    while a.length > b.length:
        a = a.before
    while b.length > a.length:
        b = b.before
    if a is b:
        return not longer
    while a.before is not b.before:
        a, b = a.before, b.before
    return a.initial < b.initial


class Repair:
    """The search over one conversation; ``push`` and ``finish`` give the edits that are settled, in order."""

    def __init__(self):
        self.root = _Edit(None, "")
        self.ways: list[tuple[int, _Edit] | None] = [(0, self.root), None, None, None]
        self.root.heads = 1
        self._move(self._with_inserts(list(self.ways)))

    @staticmethod
    def _better(way, other) -> bool:
        return other is None or way[0] < other[0] or (way[0] == other[0] and _less(way[1], other[1]))

    def _with_inserts(self, ways):
        """The ways with up to two turns inserted before the next row."""
        for a, b in ((START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
            if ways[a] is not None:
                way = (ways[a][0] + INSERT, _Edit(ways[a][1], "I", ROLE[b], ""))
                if self._better(way, ways[b]):
                    ways[b] = way
        last = ways[ASSISTANT]
        if last is not None:
            if ways[SYSTEM] is not None and self._better(last, ways[SYSTEM]):
                ways[SYSTEM] = None
            if ways[START] is not None and last[0] + DELETE < ways[START][0]:
                ways[START] = None
        return ways

    def _move(self, ways) -> None:
        """Stand on the new ways, and free what only the old ones needed."""
        old, self.ways = [w for w in self.ways if w is not None], ways
        for way in ways:
            if way is not None:
                way[1].heads += 1
                node = way[1]
                # Nodes are linked from their parent when a way on them wins.
                while node.before is not None and node not in node.before.after:
                    node.before.after.append(node)
                    node = node.before
        for _, node in old:
            node.heads -= 1
            while not node.heads and not node.after and node.before is not None:
                node.before.after.remove(node)
                node = node.before

    def _settled(self) -> Iterator[_Edit]:
        while not self.root.heads and len(self.root.after) == 1:
            self.root = self.root.after[0]
            self.root.before = None
            yield self.root
            self.root.role = self.root.text = None

    def push(self, role: str, text: str, fault: int) -> Iterator[_Edit]:
        ways: list[tuple[int, _Edit] | None] = [None] * 4

        def offer(state, cost, edit):
            if self._better((cost, edit), ways[state]):
                ways[state] = (cost, edit)

        stays = TRUNCATED if fault == 3 else 0
        for state, way in enumerate(self.ways):
            if way is None:
                continue
            cost, node = way
            offer(state, cost + DELETE, _Edit(node, "D"))
            if fault in (1, 2):
                continue
            kept = NEXT[state].get(role[:1])
            if kept is not None:
                offer(kept, cost + stays, _Edit(node, "K", role, text))
            for letter, to in NEXT[state].items():
                if letter != "s":
                    offer(to, cost + REROLE + stays, _Edit(node, "R", ROLE[to], text))
        self._move(self._with_inserts(ways))
        yield from self._settled()

    def finish(self) -> tuple[int, list[_Edit]]:
        """The cost of the cheapest repair and its edits not yet given."""
        ends = [w for w in (self.ways[START], self.ways[ASSISTANT]) if w is not None]
        best = ends[0] if len(ends) == 1 or not self._better(ends[1], ends[0]) else ends[1]
        rest, node = [], best[1]
        while node is not self.root:
            rest.append(node)
            node = node.before
        return best[0], rest[::-1]


def _events(batches):
    """("edit", conv_id, edit) of every settled edit and ("end", conv_id, counts) behind a conversation's last."""
    nobody = object()
    conv = nobody
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != conv or conv is nobody:
                if conv is not nobody:
                    yield from _ended(conv, search, seen)
                conv, search = row[0], Repair()
                seen = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "first": None, "last": None, "turns": 0, "role": None}
            _, turn, role, text, present, fault, _ = row
            if not present:
                continue
            if fault:
                seen[FAULTS[fault - 1]] += 1
            if turn is not None and turn != seen["last"]:
                seen["first"] = turn if seen["first"] is None else seen["first"]
                seen["last"], seen["turns"] = turn, seen["turns"] + 1
            if seen["role"] is not None and seen["role"] + role[:1] not in LEGAL_PAIRS:
                seen["illegal"] += 1
            seen["role"] = role[:1]
            for edit in search.push(role, text, fault):
                yield "edit", conv, edit
    if conv is not nobody:
        yield from _ended(conv, search, seen)


def _ended(conv, search, seen):
    cost, rest = search.finish()
    for edit in rest:
        yield "edit", conv, edit
    gaps = seen["last"] - seen["first"] + 1 - seen["turns"] if seen["turns"] else 0
    yield "end", conv, {**{c: seen[c] for c in (*FAULTS, "illegal")}, "gaps": gaps, "cost": cost}


def _in_order(turns: DataFrame) -> DataFrame:
    prepare(turns.sparkSession)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "place"]
    return faulted(turns).sortWithinPartitions(*order)


def repair_edits(turns: DataFrame) -> DataFrame:
    """The repaired conversations, one row per edit: conv_id, step (from 0), edit (K, R, D or I), role, text (NULL where deleted).

    ``turns``: conv_id, turn, role, text, present (boolean; NULL counts as true).
    """
    rows = _in_order(turns)
    conv_type = rows.schema["conv_id"].dataType.simpleString()

    @tidy
    def edits(batches):
        out, step = [], 0
        for what, conv, edit in _events(batches):
            if what == "end":
                step = 0
                continue
            out.append((conv, step, edit.initial, edit.role, edit.text))
            step += 1
            if len(out) == OUT_ROWS:
                yield _edit_batch(out)
                out = []
        if out:
            yield _edit_batch(out)

    return rows.mapInArrow(edits, f"conv_id {conv_type}, step long, edit string, role string, text string")


def _edit_batch(rows):
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0]), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.string()) for c in columns[2:])],
        names=["conv_id", "step", "edit", "role", "text"],
    )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_summaries(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, the counts, audit (the edits' initials) and repaired_sha256 (of ``role:text`` lines)."""
    rows = _in_order(turns)
    conv_type = rows.schema["conv_id"].dataType
    schema = f"conv_id {conv_type.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"

    @tidy
    def summaries(batches):
        out, audit, digest, lines = [], bytearray(), hashlib.sha256(), 0
        for what, conv, found in _events(batches):
            if what == "edit":
                audit += found.initial.encode()
                if found.initial != "D":
                    digest.update(f"{chr(10) if lines else ''}{found.role}:{found.text}".encode())
                    lines += 1
                continue
            out.append((conv, *(found[c] for c in COUNTS), audit.decode(), digest.hexdigest()))
            audit, digest, lines = bytearray(), hashlib.sha256(), 0
            if len(out) == OUT_ROWS:
                yield _summary_batch(out)
                out = []
        if out:
            yield _summary_batch(out)

    return rows.mapInArrow(summaries, schema)


def _summary_batch(rows):
    columns = list(zip(*rows))
    arrays = [pa.array(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:-2]), *(pa.array(c, pa.string()) for c in columns[-2:])]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *COUNTS, "audit", "repaired_sha256"])


def damage_code(conv_id: Column, turn: Column) -> Column:
    text = F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)))
    return (F.crc32(text) % 20).cast("int")


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's damage: a row is dropped (not ``present``), emptied, stripped of stops, repeated or given the role user."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    code = damage_code(F.col("conv_id"), F.col("turn"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = rows.withColumn("code", code)
    hurt = rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("code") != 0).alias("present"), times.alias("copy"))
    return hurt.drop("copy")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair_summaries(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _oracle() -> str:
    """The same least-cost search as a recursive query, a state a column, each holding (cost, audit, repaired text)."""

    def best(*ways):
        return f"list_min(list_filter([{', '.join(ways)}], lambda w: w.c IS NOT NULL))"

    def way(state, cost, initial, line=None):
        out = f"{state}.o" if line is None else f"{state}.o || CASE WHEN {state}.n > 0 THEN chr(10) ELSE '' END || {line}"
        n = f"{state}.n" if line is None else f"{state}.n + 1"
        return f"{{'c': {state}.c + {cost}, 'p': {state}.p || '{initial}', 'o': {out}, 'n': {n}}}"

    def gated(test, state, cost, initial, line):
        return way(state, f"CASE WHEN {test} THEN {cost} END", initial, line)

    line = "r.role || ':' || r.text"
    stays = "CASE WHEN r.fault = 3 THEN 3 ELSE 0 END"
    free, deleted = "r.fault NOT IN (1, 2)", lambda s: way(s, 4, "D")
    keep = lambda s, letter: gated(f"{free} AND r.i = '{letter}'", s, stays, "K", line)
    turn = lambda s, role: gated(free, s, f"3 + {stays}", "R", f"'{role}:' || r.text")
    moved = {
        "a": deleted("x.a"),
        "s": best(deleted("x.s"), keep("x.a", "s")),
        "u": best(deleted("x.u"), *(f(s, w) for s in ("x.a", "x.s", "x.t") for f, w in ((keep, "u"), (turn, "user")))),
        "t": best(deleted("x.t"), keep("x.u", "a"), turn("x.u", "assistant")),
    }
    inserted_u = best("y.u", way("y.a", 3, "I", "'user:'"), way("y.s", 3, "I", "'user:'"))
    inserted_t = best("z.t", way("z.u", 3, "I", "'assistant:'"))
    inserted_u2 = best("q.u", way("q.t", 3, "I", "'user:'"))
    closure = (
        f"SELECT q.conv_id, q.k, q.a, q.s, {inserted_u2} AS u, q.t FROM (SELECT z.conv_id, z.k, z.a, z.s, z.u, {inserted_t} AS t "
        f"FROM (SELECT y.conv_id, y.k, y.a, y.s, {inserted_u} AS u, y.t FROM (INNER_ROWS) y) z) q"
    )
    none = "{'c': NULL::BIGINT, 'p': '', 'o': '', 'n': 0}"
    begin = f"SELECT conv_id, 0 AS k, {{'c': 0::BIGINT, 'p': '', 'o': '', 'n': 0}} AS a, {none} AS s, {none} AS u, {none} AS t FROM every"
    step = (
        f"SELECT x.conv_id, x.k + 1 AS k, {moved['a']} AS a, {moved['s']} AS s, {moved['u']} AS u, {moved['t']} AS t "
        "FROM search x JOIN judged r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.k = x.k + 1"
    )
    return (
        "WITH RECURSIVE " + _ORACLE_ROWS + f", search AS ({closure.replace('INNER_ROWS', begin)} UNION ALL {closure.replace('INNER_ROWS', step)}), "
        "last AS (SELECT conv_id, " + best("search.a", "search.t") + " AS w FROM search "
        "QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1), "
        "counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, "
        "count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, "
        "count(*) FILTER (k > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id) "
        "SELECT last.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, "
        "coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, w.c AS cost, w.p AS audit, sha256(w.o) AS repaired_sha256 "
        "FROM last LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM last.conv_id"
    )


#: crc32 of the text ``s``, a bit at a time.
CRC32_SQL = (
    "xor(list_reduce(range(0, 8 * length(s)), lambda c, k: "
    "xor((CASE WHEN k % 8 = 0 THEN xor(c, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE c END) >> 1, "
    "((CASE WHEN k % 8 = 0 THEN xor(c, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE c END) & 1) * 3988292384), "
    "4294967295::BIGINT), 4294967295::BIGINT)"
)
_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ORACLE_ROWS = f"""
every AS (SELECT DISTINCT conv_id FROM conversations),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC32_SQL} % 20 AS code
  FROM (SELECT *, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS s FROM conversations)
), hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM raw WHERE code <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM hurt
), judged AS (
  SELECT conv_id, turn, role, text, k, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before,
         CASE WHEN trim(text, {_BLANKS_SQL}) = '' THEN 1
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
              WHEN right(rtrim(text, {_BLANKS_SQL}), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM placed
)"""
OP12_SQL = _oracle()
