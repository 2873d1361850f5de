"""Exact substring de-duplication by a common-prefix-aware distributed merge sort of suffixes.

A byte goes when a string of ``length`` bytes that covers it starts anywhere
else, too.  Sorting every suffix of the corpus isn't needed to decide that.
Each string of ``length`` bytes names one *anchor* in itself: its leftmost
least-hashed ``gram`` (a minimizer).  Equal strings name the same anchor at
the same place, so only suffixes at anchors whose gram was seen twice can
matter; a pair of Bloom filters finds those (a passing single is harmless).

1. every task adds its anchors' gram hashes to the filters, merged by slices;
2. every task cuts at each suspect anchor the suffix (up to ``length`` bytes)
   and the bytes before it, sorts them to a run per bucket of gram hashes,
   equal ones once, and front-codes the run: only the bytes behind the prefix
   shared with the one before are sent;
3. a bucket's runs are merged by a loser tree that keeps each run's common
   prefix with the last winner and never compares those bytes again.  The
   merged order comes with the common prefix of neighbours, which says for
   every depth which suffixes are equal so far; with the same for the bytes
   before the anchor, read backwards, each suffix learns which of its strings
   of ``length`` bytes occur again;
4. a gram of more than about ``HOT_PLACES`` places takes no part in that: its
   distinct surroundings are halved by how many bytes of the string lie before
   the anchor, again and again, each half keyed by the bytes all its strings
   have, equal surroundings kept once, until a key's group is small
   (``hot_spans``), so no task holds a group that grows with the input;
5. the covered bytes of a text are united, in the task that finds them and
   again by parts of all texts (by digest), and cut out.  Texts that no
   span can concern (a Bloom filter of the digests) aren't shuffled.

Places are named by text digest, so exact copies of a text are one place with
a count.  Nothing is decided by a gram hash: equality always comes from
sorted bytes.

Defined cases: a NULL or empty text has no bytes and loses none; texts
shorter than ``length`` never lose a byte; repeated rows are occurrences of
each other; other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanmart.llm import bloom
from chanmart.llm.common import byte_texts, few_texts, prepare, release, staged, tidy

LENGTH = 200
GRAM = 64
#: Text bytes per anchor, less than there are: a window holds ``length - gram + 1`` grams and one anchor at least.
ANCHOR_BYTES = 40
#: Text bytes whose rolling hashes are held at once.
CHUNK_BYTES = 1 << 20
#: Text bytes a bucket of the merge stands for.
BUCKET_BYTES = 4 << 20
#: Suffixes that a task holds before it sends them as runs.
HELD_SUFFIXES = 50_000
#: Places of one gram, and surroundings under one key, that a task may hold at once.
HOT_PLACES = 10_000
#: Hashes whose counts a task keeps to find such grams.
COUNTED = 1 << 14
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64, remembered."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 20), base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' anchors: text number, place in the text, gram hash."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    n = len(flat)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    h = _mix((sums[gram:] - sums[:-gram]) * _power(_INVERSE, n - gram + 1))
    bits = np.uint64(int(n).bit_length())
    least = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while have < width:  # minima over windows of doubling width
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    whole = np.zeros(len(least) + 1, np.int32)  # +1 where a text's windows begin, -1 behind the last
    long = sizes >= length
    np.add.at(whole, starts[long], 1)
    np.add.at(whole, starts[long] + sizes[long] - length + 1, -1)
    at = (least[np.cumsum(whole[:-1]) > 0] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
    text = np.searchsorted(starts, at, side="right") - 1
    # empty texts share their start with the next one: the last of them is the text that holds the byte
    return text, at - starts[text], h[at]


def front_code(suffixes: list[bytes]) -> tuple[bytes, bytes]:
    """Common prefix lengths with the suffix before (16 bit each) and length-prefixed rests of a sorted run."""
    shared, rest, last = [], [], b""
    for s in suffixes:
        k = common_prefix(last, s, 0)
        shared.append(k)
        rest.append(len(s) - k)
        last = s
    tails = b"".join(s[k:] for s, k in zip(suffixes, shared))
    return np.array([shared, rest], np.uint16).tobytes(), tails


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look; doubling steps, then halving."""
    most = min(len(a), len(b))
    low, step = known, 8
    while low < most and a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    if low >= most:
        return most
    high = min(most, low + step)
    while low < high:
        middle = (low + high) // 2
        if a[low : middle + 1] == b[low : middle + 1]:
            low = middle + 1
        else:
            high = middle
    return low


def _pack_run(entries: dict[tuple[bytes, bytes], dict[bytes, list]]) -> bytes:
    """A sorted, front-coded and compressed run of {(suffix, before): {digest + place: count}}."""
    keys = sorted(entries)
    coded, tails = front_code([s for s, _ in keys])
    befores = [b for _, b in keys]
    places = [entries[k] for k in keys]
    parts = [
        coded,
        tails,
        np.fromiter(map(len, befores), np.uint16, len(keys)).tobytes(),
        b"".join(befores),
        np.fromiter(map(len, places), np.uint32, len(keys)).tobytes(),
        b"".join(p for x in places for p in x),
        np.fromiter((n for x in places for n in x.values()), np.uint32, sum(map(len, places))).tobytes(),
    ]
    head = np.array([len(keys), *map(len, parts)], np.uint64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


PLACE = 24  # bytes: a text's digest (16) and a place in it (8)


def _unpack_run(blob: bytes):
    """(common prefix with the one before, suffix, before, places, counts) of a run, in order."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, *sizes = np.frombuffer(raw[:64], np.uint64).tolist()
    parts, at = [], 64
    for s in sizes:
        parts.append(raw[at : at + s])
        at += s
    shared, rest = np.frombuffer(parts[0], np.uint16).reshape(2, n).tolist()
    n_before = np.frombuffer(parts[2], np.uint16).tolist()
    n_places = np.frombuffer(parts[4], np.uint32).tolist()
    counts = np.frombuffer(parts[6], np.uint32).tolist()
    last, t, b, p = b"", 0, 0, 0
    for i in range(n):
        last = last[: shared[i]] + parts[1][t : t + rest[i]]
        places = [parts[5][(p + j) * PLACE : (p + j + 1) * PLACE] for j in range(n_places[i])]
        yield shared[i], last, parts[3][b : b + n_before[i]], places, counts[p : p + n_places[i]]
        t, b, p = t + rest[i], b + n_before[i], p + n_places[i]


def merge_runs(runs) -> Iterator[tuple]:
    """Merge sorted runs of (shared, suffix, ...) by a loser tree; yields (common prefix with the one before, suffix, ...).

    Every waiting item knows its common prefix with the last winner on its
    path.  Of two items the one with the longer prefix is the smaller, without
    a look at any byte; only at equal prefixes are the bytes behind compared.
    """
    sources = [iter(r) for r in runs]
    k = max(1, len(sources))
    items = [next(s, None) for s in sources]
    lcp = [0] * k  # with the last winner
    tree = [-1] * k  # losers; tree[0] is the winner

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix becomes the one it shares with the winner."""
        if items[a] is None:
            return b, a
        if items[b] is None:
            return a, b
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = items[a][1], items[b][1]
        shared = common_prefix(x, y, lcp[a])
        if (x, a) <= (y, b) if shared == min(len(x), len(y)) else x[shared] < y[shared]:
            lcp[b] = shared
            return a, b
        lcp[a] = shared
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, tree[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    while items and items[winner] is not None:
        item = items[winner]
        yield (lcp[winner], *item[1:])
        items[winner] = following = next(sources[winner], None)
        lcp[winner] = following[0] if following is not None else 0
        node = (winner + k) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


def _common_suffix(a: bytes, b: bytes) -> int:
    return common_prefix(a[::-1], b[::-1], 0)


def repeated_parts(shared: list[int], suffixes: list[bytes], befores: list[bytes], times: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For sorted suffixes of one gram: the spans (from, to), relative to the anchor, that strings occurring again cover.

    ``shared[i]`` is the common prefix of suffixes i - 1 and i; ``times[i]``
    the number of occurrences of exactly these bytes.
    """
    n = len(suffixes)
    spans: list[list[tuple[int, int]]] = [[(-len(b), len(s))] if t > 1 and len(b) + len(s) >= length else [] for s, b, t in zip(suffixes, befores, times)]
    if n <= 12:
        for i in range(n):
            right = len(suffixes[i])
            for j in range(i + 1, n):
                right = min(right, shared[j])
                left = _common_suffix(befores[i], befores[j])
                if left + right >= length:
                    spans[i].append((-left, right))
                    spans[j].append((-left, right))
        return spans
    lcp = np.array(shared)
    lcp[0] = 0
    size = np.array([len(s) for s in suffixes])
    turned = [b[::-1] for b in befores]
    order = sorted(range(n), key=turned.__getitem__)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    back = np.array([0] + [common_prefix(turned[a], turned[b], 0) for a, b in zip(order, order[1:])])
    back_size = np.array([len(turned[i]) for i in order])
    most = int(back_size.max())
    again = np.zeros((n, most + 2), np.int8)
    for j in range(max(0, length - int(size.max())), most + 1):
        ok = (size >= length - j) & (back_size[place] >= j)
        rows = np.flatnonzero(ok)
        if len(rows) < 2:
            continue
        # equal right parts at this depth are neighbours in order, equal left parts in the order read backwards
        key = np.cumsum(lcp < length - j)[rows] * (n + 1) + np.cumsum(back < j)[place][rows]
        ordered = np.argsort(key, kind="stable")
        same = key[ordered][1:] == key[ordered][:-1]
        hit = np.zeros(len(rows), bool)
        hit[ordered[1:][same]] = True
        hit[ordered[:-1][same]] = True
        again[rows[hit], j + 1] = 1
    edge = np.diff(again, axis=1, append=0)
    for i in np.flatnonzero(again.any(axis=1)):
        first, last = np.flatnonzero(edge[i] == 1), np.flatnonzero(edge[i] == -1)
        for a, b in zip(first.tolist(), last.tolist()):  # left lengths a .. b - 1, as column 0 stands for none
            spans[i].append((-(b - 1), length - a))
    return spans


#: Covered spans on their way: those of a part of all texts (by digest), packed.
SPANS = "part int, spans binary"
_SPAN = np.dtype([("a", "<u8"), ("b", "<u8"), ("first", "<i8"), ("last", "<i8")])  # a and b: the digest
#: Spans that a task holds before it unites and sends them.
HELD_SPANS = 200_000


def span_array(digests: bytes, first, last) -> np.ndarray:
    """``_SPAN`` rows of 16-byte digests, one after the other, and their spans."""
    out = np.empty(len(digests) // 16, _SPAN)
    both = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    out["a"], out["b"], out["first"], out["last"] = both[:, 0], both[:, 1], first, last
    return out


def united(spans: np.ndarray) -> np.ndarray:
    """Spans by text and place, those of a text that touch made one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["first"], spans["b"], spans["a"]))]
    new = np.concatenate([[True], (spans["a"][1:] != spans["a"][:-1]) | (spans["b"][1:] != spans["b"][:-1])])
    # Texts one behind the other, so that one running maximum serves all.
    base = (np.cumsum(new) - 1) * (int(spans["last"].max()) + 2)
    ends = np.maximum.accumulate(spans["last"] + base)
    starts = np.flatnonzero(np.concatenate([[True], (spans["first"] + base)[1:] > ends[:-1]]))
    out = spans[starts]
    out["last"] = (ends - base)[np.concatenate([starts[1:] - 1, [len(spans) - 1]])]
    return out


def span_batch(spans: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row for each part of the texts that the spans are of."""
    spans = united(spans)
    part = (spans["a"] % np.uint64(parts)).astype(np.int64)
    spans, part = spans[np.argsort(part, kind="stable")], np.sort(part)
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    pack = zstandard.ZstdCompressor(level=1)
    blobs = [pack.compress(spans[i:j].tobytes()) for i, j in zip(at, [*at[1:], len(spans)])]
    return pa.RecordBatch.from_arrays([pa.array(part[at], pa.int32()), pa.array(blobs, pa.binary())], names=["part", "spans"])


def spans_of_texts(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, spans) of one part's texts: all that was found of them, united."""
    unpack = zstandard.ZstdDecompressor()
    found = [np.frombuffer(unpack.decompress(x), _SPAN) for batch in batches for x in batch.column("spans").to_pylist()]
    spans = united(np.concatenate(found) if found else np.zeros(0, _SPAN))
    new = np.flatnonzero(np.concatenate([[True], (spans["a"][1:] != spans["a"][:-1]) | (spans["b"][1:] != spans["b"][:-1])])) if len(spans) else np.zeros(0, np.int64)
    digests = np.stack([spans["a"][new], spans["b"][new]], axis=1).astype("<u8").tobytes()
    of = pa.StructArray.from_arrays([pa.array(spans["first"]), pa.array(spans["last"])], names=["first", "last"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([new, [len(spans)]]), pa.int32()), of)
    yield pa.RecordBatch.from_arrays([pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(new), [None, pa.py_buffer(digests)]).cast(pa.binary()), lists], names=["digest", "spans"])


def _bucket_spans(runs, length: int, gram: int):
    """(digest, from, to) of every place in a bucket's runs."""
    group: list[tuple] = []
    merged = merge_runs([_unpack_run(r) for r in runs])

    def flush():
        if not group or len(group) == 1 and sum(group[0][4]) == 1:
            return
        # equal suffixes with equal bytes before are one; a place met twice is counted, not listed twice
        order, seen = [], {}
        for at, (shared, suffix, before, places, counts) in enumerate(group):
            known = seen.get((suffix, before))
            if known is None:
                known = seen[suffix, before] = (len(order), {})
                order.append((at, suffix, before))
            for p, c in zip(places, counts):
                known[1][p] = known[1].get(p, 0) + c
        lcp, low, kept = [], 1 << 30, iter(order)
        nxt = next(kept)
        for at, item in enumerate(group):
            low = min(low, item[0])
            if nxt is not None and at == nxt[0]:
                lcp.append(low)
                low = 1 << 30
                nxt = next(kept, None)
        times = [sum(seen[s, b][1].values()) for _, s, b in order]
        found = repeated_parts(lcp, [s for _, s, _ in order], [b for _, _, b in order], times, length)
        for (_, s, b), spans in zip(order, found):
            if spans:
                for p in seen[s, b][1]:
                    at = int.from_bytes(p[16:], "little")
                    for x, y in spans:
                        yield p[:16], at + x, at + y

    for item in merged:
        if group and item[0] < gram:
            yield from flush()
            group.clear()
        group.append(item)
    yield from flush()


def _digest(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


class Frequent:
    """Counts of a task's most frequent hashes in bounded memory (Misra-Gries): short by at most 1 / ``size`` of all that was added."""

    def __init__(self, size: int = COUNTED):
        self.size = size
        self.hashes, self.times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        known, place = np.unique(np.concatenate([self.hashes, hashes]), return_inverse=True)
        times = np.bincount(place, np.concatenate([self.times, np.ones(len(hashes), np.int64)])).astype(np.int64)
        if len(known) > self.size:
            times -= np.partition(times, -self.size - 1)[-self.size - 1]
        self.hashes, self.times = known[times > 0], times[times > 0]

    def batch(self) -> pa.RecordBatch:
        """Those counted more than once."""
        again = self.times > 1
        n = int(again.sum())
        empty = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
        return pa.RecordBatch.from_arrays([*empty, pa.array(self.hashes[again].view(np.int64)), pa.array(self.times[again])], names=["slice", "once", "twice", "gram", "n"])


def _small_groups(length: int):
    """Spans (cid, first, last) of the surroundings in each small group (lo, hi, key)."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, list] = {}
        for batch in batches:
            for lo, hi, k, s, b, t, cid in zip(*(batch.column(n).to_pylist() for n in ("lo", "hi", "key", "s", "b", "t", "cid"))):
                groups.setdefault((lo, hi, k), []).append((s, b, t, cid))
        for rows in groups.values():
            if len(rows) < 2:
                continue
            rows.sort()
            suffixes = [r[0] for r in rows]
            shared = [0, *(common_prefix(x, y, 0) for x, y in zip(suffixes, suffixes[1:]))]
            found = repeated_parts(shared, suffixes, [r[1] for r in rows], [r[2] for r in rows], length)
            out = [(r[3], x, y) for r, spans in zip(rows, found) for x, y in spans]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["cid", "first", "last"])

    return run


def hot_spans(contexts: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """(cid, first, last), relative to the anchor, of distinct surroundings (cid, s from the anchor on, b before it, t times).

    A node lo..hi stands for the strings with lo to hi bytes before the anchor.
    All of them have the ``lo`` bytes before and the ``length - hi`` from the
    anchor on, the node's key, and lie in the ``hi`` bytes before and the
    ``length - lo`` after, the node's view.  Equal views settle each other: all
    their strings occur again, and one goes on as the others' witness.  Of a
    node with lo = hi the view is the key, so halving ends.
    """
    of = ["lo", "hi"]
    rows = contexts.filter(F.octet_length("s") + F.octet_length("b") >= length).withColumns({"lo": F.lit(0), "hi": F.lit(length - gram)})
    whole = lambda df: df.select("cid", (-F.octet_length("b")).cast("long").alias("first"), F.octet_length("s").cast("long").alias("last"))
    found = [whole(rows.filter("t > 1"))]
    while True:
        middle = ((F.col("lo") + F.col("hi")) / 2).cast("int")
        node = F.explode(F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct((middle + 1).alias("lo"), F.col("hi"))))
        halves = rows.select("cid", "s", "b", "t", node.alias("node")).select("cid", "s", "b", "t", "node.lo", "node.hi")
        halves = halves.filter((F.col("lo") <= F.col("hi")) & (F.octet_length("b") >= F.col("lo")) & (F.octet_length("s") >= length - F.col("hi")))
        seen = F.least(F.octet_length("b"), F.col("hi"))
        view = {"s": F.expr(f"substring(s, 1, {length} - lo)"), "b": F.substring("b", F.octet_length("b") - seen + 1, seen)}
        halves = staged(halves.withColumns(view).filter(F.octet_length("s") + F.octet_length("b") >= length), "hot-halves")
        key = F.xxhash64(F.expr("substring(b, octet_length(b) - lo + 1, lo)"), F.expr(f"substring(s, 1, {length} - hi)"))
        views = halves.groupBy(*of, "s", "b").agg(F.sum("t").alias("t"), F.count(F.lit(1)).alias("n"), F.min("cid").alias("cid"))
        views = staged(views.withColumn("key", key), "hot-views")
        equal = views.filter("n > 1").select(*of, "s", "b")
        found.append(staged(whole(halves.join(equal, [*of, "s", "b"], "left_semi")), "hot-spans"))
        sizes = views.groupBy(*of, "key").agg(F.count(F.lit(1)).alias("size"))
        large = staged(sizes.filter(F.col("size") > most).select(*of, "key"), "hot-keys")  # at most one in ``most`` rows
        small = views.join(F.broadcast(large), [*of, "key"], "left_anti")
        parts = max(1, -(-views.count() // most))
        dealt = small.withColumn("part", F.pmod(F.xxhash64(*of, "key"), F.lit(parts))).groupBy("part")
        found.append(staged(dealt.applyInArrow(_small_groups(length), "cid long, first long, last long"), "hot-spans"))
        if large.limit(1).count() == 0:
            break
        rows = views.join(F.broadcast(large), [*of, "key"], "left_semi").select("cid", "s", "b", "t", *of)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _hot_places(texts: DataFrame, hot, length: int, gram: int, most: int, parts: int) -> DataFrame:
    """``SPANS`` of the places of the hot grams (a broadcast, sorted array)."""
    before = length - gram

    @tidy
    def places(batches):
        held: dict[tuple[bytes, bytes], dict[bytes, int]] = {}
        n = 0

        def out():
            columns = [[s for s, _ in held], [b for _, b in held], [b"".join(x) for x in held.values()]]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in columns), pa.array([sum(x.values()) for x in held.values()], pa.int64())], names=["s", "b", "places", "n"])

        for batch in batches:
            raw = byte_texts(batch.column(0))
            for a, b in few_texts(raw, CHUNK_BYTES):
                text, at, h = anchors(raw[a:b], length, gram)
                keep = np.isin(h, hot.value)
                digests: dict[int, bytes] = {}
                for t, p in zip(text[keep].tolist(), at[keep].tolist()):
                    whole = raw[a + t]
                    if t not in digests:
                        digests[t] = _digest(whole)
                    entry = held.setdefault((whole[p : p + length], whole[max(0, p - before) : p]), {})
                    place = digests[t] + p.to_bytes(8, "little")
                    entry[place] = entry.get(place, 0) + 1
                    n += 1
                if n > 20_000:
                    yield out()
                    held.clear()
                    n = 0
        yield out()

    @tidy
    def spread(batches):
        held, n = [], 0
        for batch in batches:
            for places, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = np.frombuffer(places, np.dtype([("digest", "V16"), ("at", "<i8")]))
                digests = at["digest"].tobytes()
                for x, y in _merged(spans):
                    held.append(span_array(digests, at["at"] + x, at["at"] + y))
                    n += len(at)
                if n >= HELD_SPANS:
                    yield span_batch(np.concatenate(held), parts)
                    held, n = [], 0
        if held:
            yield span_batch(np.concatenate(held), parts)

    # a task's places of the same surroundings are one row, so common surroundings are a row a task
    found = staged(texts.mapInArrow(places, "s binary, b binary, places binary, n long"), "hot-places")
    contexts = found.groupBy("s", "b").agg(F.sum("n").alias("t"))
    contexts = staged(contexts.withColumn("cid", F.monotonically_increasing_id()), "hot-contexts")
    spans = hot_spans(contexts, length, gram, most).groupBy("cid").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"))
    wanted = contexts.join(spans, "cid").select("s", "b", "spans")
    return found.join(wanted, ["s", "b"]).select("places", "spans").mapInArrow(spread, SPANS)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text_col: str = "text", bits: int | None = None, bucket_bytes: int = BUCKET_BYTES, hot_places: int = HOT_PLACES
) -> DataFrame:
    """digest (128-bit hash of a text) and spans, array of (first, last) with last exclusive, of texts that lose bytes."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter(F.octet_length("text") >= length)
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = bits or bloom.bits_for(total // ANCHOR_BYTES)

    @tidy
    def sketch(batches):
        seen, frequent = bloom.SeenTwice(bits), Frequent()
        for batch in batches:
            raw = byte_texts(batch.column(0))
            for a, b in few_texts(raw, CHUNK_BYTES):
                found = anchors(raw[a:b], length, gram)[2]
                if len(found):
                    seen.add(found)
                    frequent.add(found)
        slices = bloom.slice_batch(seen)
        none = pa.nulls(slices.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*slices.columns, none, none], names=[*slices.schema.names, "gram", "n"])
        yield frequent.batch()

    sketched = staged(texts.mapInArrow(sketch, f"{bloom.SLICES}, gram long, n long"), "gram-sketches")
    twice = spark.sparkContext.broadcast(bloom.merged_twice(sketched.filter("slice IS NOT NULL").select("slice", "once", "twice"), bits))
    counted = sketched.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > hot_places)
    # at most one in ``hot_places`` anchors
    hot = spark.sparkContext.broadcast(np.sort(np.array([r["gram"] for r in counted.select("gram").collect()], np.int64).view(np.uint64)))
    buckets = max(64, -(-total // bucket_bytes))
    before = length - gram

    @tidy
    def runs(batches):
        held: dict[int, dict] = {}
        n = 0

        def out():
            keys = sorted(held)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([_pack_run(held[k]) for k in keys], pa.binary())], names=["bucket", "run"])

        for batch in batches:
            raw = byte_texts(batch.column(0))
            for a, b in few_texts(raw, CHUNK_BYTES):
                text, at, h = anchors(raw[a:b], length, gram)
                keep = bloom.probe(twice.value, h, bits) if len(h) else np.zeros(0, bool)
                if len(hot.value):
                    keep &= ~np.isin(h, hot.value)
                digests: dict[int, bytes] = {}
                for t, p, k in zip(text[keep].tolist(), at[keep].tolist(), (h[keep] % np.uint64(buckets)).tolist()):
                    whole = raw[a + t]
                    digest = digests.get(t)
                    if digest is None:
                        digest = digests[t] = _digest(whole)
                    entry = held.setdefault(k, {}).setdefault((whole[p : p + length], whole[max(0, p - before) : p]), {})
                    place = digest + p.to_bytes(8, "little")
                    entry[place] = entry.get(place, 0) + 1
                    n += 1
                if n > HELD_SUFFIXES:
                    yield out()
                    held.clear()
                    n = 0
                    release()
        if held:
            yield out()

    sent = texts.mapInArrow(runs, "bucket int, run binary")

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for batch in batches for x in batch.column("run").to_pylist()]
        rows: list[tuple] = []
        held: list[np.ndarray] = []

        def pack():
            digests, first, last = zip(*rows)
            held.append(span_array(b"".join(digests), first, last))
            rows.clear()

        for row in _bucket_spans(blobs, length, gram):
            rows.append(row)
            if len(rows) >= HELD_SPANS // 16:
                pack()
            if len(held) >= 16:
                yield span_batch(np.concatenate(held), buckets)
                held.clear()
        if rows:
            pack()
        if held:
            yield span_batch(np.concatenate(held), buckets)
        # Workers outlive their groups: what a bucket took goes back.
        blobs.clear()
        held.clear()
        release()

    found = sent.groupBy("bucket").applyInArrow(merge, SPANS)
    if len(hot.value):
        found = found.unionByName(_hot_places(texts, hot, length, gram, hot_places, buckets))
    return found.groupBy("part").applyInArrow(spans_of_texts, "digest binary, spans array<struct<first:long,last:long>>")


def _digest_hash(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2].copy()


def _merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in spans:
        a, b = s["first"], s["last"]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    keep, at = [], 0
    for a, b in spans:
        keep.append(text[at:a])
        at = b
    return b"".join([*keep, text[at:]])


def dedup_substrings(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text_col: str = "text", bits: int | None = None, bucket_bytes: int = BUCKET_BYTES, hot_places: int = HOT_PLACES
) -> DataFrame:
    """The documents plus ``kept`` (binary, the bytes that stay), ``n_bytes``, ``n_removed`` and ``n_spans``.

    Input columns of these names are replaced; ``kept`` is binary since a cut
    may fall inside a character.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    names = docs.columns
    spans = staged(repeated_spans(docs, length, gram, text_col, bits, bucket_bytes, hot_places), "repeated-spans")
    bits = bits or bloom.bits_for(spans.count())

    @tidy
    def add(batches):
        seen = bloom.SeenTwice(bits)
        for batch in batches:
            if batch.num_rows:
                h = _digest_hash(batch.column(0).to_pylist())
                seen.add(np.concatenate([h, h]))
        yield bloom.slice_batch(seen)

    sent = docs.sparkSession.sparkContext.broadcast(bloom.merged_twice(spans.select("digest").mapInArrow(add, bloom.SLICES), bits))
    extra = [T.StructField("kept", T.BinaryType()), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans"))]
    schema = T.StructType([*docs.schema.fields, *extra])

    def with_result(batch, texts, found):
        kept = [_without(t, s) for t, s in zip(texts, found)]
        removed = [sum(b - a for a, b in s) for s in found]
        columns = [pa.array(kept, pa.binary()), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) for s in found], pa.int64())]
        return pa.RecordBatch.from_arrays([*batch.select(names).columns, *columns], names=[*names, "kept", "n_bytes", "n_removed", "n_spans"])

    @tidy
    def untouched(batches):
        for batch in batches:
            texts = byte_texts(batch.column(batch.schema.get_field_index(text_col)))
            rows = np.flatnonzero(~bloom.probe(sent.value, _digest_hash([_digest(t) for t in texts]), bits)) if texts else []
            texts = [texts[i] for i in rows]
            yield with_result(batch.take(pa.array(rows, pa.int64())), texts, [[] for _ in texts])

    @tidy
    def touched(batches):
        for batch in batches:
            digests = [_digest(t) for t in byte_texts(batch.column(batch.schema.get_field_index(text_col)))]
            rows = pa.array(np.flatnonzero(bloom.probe(sent.value, _digest_hash(digests), bits)) if digests else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.take(rows).columns, pa.array(digests, pa.binary()).take(rows)], names=[*names, "__digest"])

    @tidy
    def cut(batches):
        for batch in batches:
            texts = byte_texts(batch.column(batch.schema.get_field_index(text_col)))
            yield with_result(batch, texts, [_merged(s or []) for s in batch.column(batch.num_columns - 1).to_pylist()])

    perhaps = docs.mapInArrow(touched, T.StructType([*docs.schema.fields, T.StructField("__digest", T.BinaryType())]))
    theirs = spans.select(F.col("digest").alias("__of"), F.col("spans").alias("__spans"))
    joined = perhaps.join(theirs, F.col("__digest") == F.col("__of"), "left").select(*names, "__spans")
    return docs.mapInArrow(untouched, schema).unionByName(joined.mapInArrow(cut, schema))


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
