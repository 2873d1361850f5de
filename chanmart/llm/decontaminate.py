"""Benchmark decontamination with one FM-index per shard of documents.

A shard (one Arrow batch of documents) becomes one word sequence.  Words that
no benchmark item has can't be in a match, so they share the separator
symbol, and stretches between separators that are shorter than the shortest
searched window are left out before the index is built: an exact reduction of
the alphabet and the sequence, made from the searched windows alone.  Every
window of every item is searched backward through wavelet-tree ranks; the
occurrences are located by sampled suffix positions and merged to spans.

Benchmark texts reach the tasks in blocks of about ``block_bytes``.  A task
searches its shard for one block after the other, of up to ``BLOCKS_A_PASS`` in
one pass over the documents, and merges the spans by document.

Defined cases: a NULL or wordless text has no words and no hits; NULL or
wordless items have no window; rows that repeat an item_id are one item (hit
when any of its windows occurs); a NULL item_id hits words but can't be
listed; repeated documents are judged each by itself; empty tables give no
rows, or no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanmart.llm.common import byte_texts, prepare, replaced, staged, tidy
from chanmart.llm.fm_index import FMIndex

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: Blocks that a task is sent at once, and the text that it searches for one block before the next where there are several.
BLOCKS_A_PASS, SHARD_BYTES = 16, 8 << 20
#: 0-9, a-z and all bytes of other scripts stay, A-Z are lower-cased, the rest become blanks.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Windows:
    """The distinct windows of a block of items, by length, in symbols of the items' own words."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            ws = words(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[i : i + window]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[set]]] = {}
        for n in sorted({len(k) for k in owners}):
            keys = [k for k in owners if len(k) == n]
            self.by_length[n] = np.array(keys, np.int64), [owners[k] for k in keys]
        self.shortest = min(self.by_length, default=0)

    def occurrences(self, sequence: np.ndarray):
        """(position, length, owners) of every window's every occurrence in a symbol sequence."""
        keep = _stretches(sequence, self.shortest)
        if not len(keep):
            return
        packed, origin = _pack(sequence, keep)
        index = FMIndex(packed, len(self.vocabulary) + 1)
        for length, (phrases, owners) in self.by_length.items():
            lo, hi = index.search(phrases)
            found = np.flatnonzero(hi > lo)
            if not len(found):
                continue
            counts = (hi - lo)[found]
            which = np.repeat(found, counts)
            rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo[found], counts)
            yield origin[index.locate(rows)], length, which, owners


def _stretches(sequence: np.ndarray, shortest: int) -> np.ndarray:
    """Starts and ends of the stretches without separator of at least ``shortest`` symbols."""
    edge = np.diff(np.concatenate([[0], (sequence > 0).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= max(1, shortest)
    return np.stack([starts[long], ends[long]], axis=1)


def _pack(sequence: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept stretches, a separator after each, and each place's position in the sequence."""
    lengths = keep[:, 1] - keep[:, 0] + 1
    origin = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(keep[:, 0], lengths)
    packed = sequence[np.minimum(origin, len(sequence) - 1)].copy()
    packed[np.cumsum(lengths) - 1] = 0
    return packed, origin


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
#: Result columns.
FOUND = (("n_words", T.LongType()), ("hit_spans", SPANS), ("hit_items", T.ArrayType(T.LongType())))


def _search(batch_texts: list[bytes], windows: Windows):
    """Per text: number of words, merged hit word spans [first, last], items whose windows occur."""
    vocabulary = windows.vocabulary.get
    counts, parts = [], []
    for text in batch_texts:
        ws = words(text)
        counts.append(len(ws))
        parts.append(np.fromiter((vocabulary(w, 0) for w in ws), np.int64, len(ws)))
        parts.append(np.zeros(1, np.int64))  # between documents
    sequence = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(np.array(counts, np.int64) + 1)])
    cover = np.zeros(len(sequence) + 1, np.int64)
    items: dict[int, set] = {}
    if windows.by_length:
        for at, length, which, owners in windows.occurrences(sequence):
            np.add.at(cover, at, 1)
            np.add.at(cover, at + length, -1)
            doc = np.searchsorted(starts, at, side="right") - 1
            for d, k in set(zip(doc.tolist(), which.tolist())):
                items.setdefault(d, set()).update(owners[k])
    edge = np.diff(np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    doc = np.searchsorted(starts, first, side="right") - 1
    spans: dict[int, list] = {}
    for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist()):
        spans.setdefault(d, []).append((a - int(starts[d]), b - int(starts[d])))
    return counts, spans, items


def _item_blocks(benchmark: DataFrame, text_col: str, id_col: str, block_bytes: int):
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    # equal rows add nothing and would all hash to one block
    items = staged(items.distinct(), "benchmark-items")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        rows = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        # a block's bytes are bounded; it is read when its pass is made
        yield lambda rows=rows: [(r["item_id"], r["text"].encode()) for r in rows.collect()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents plus ``n_words``, ``hit_spans`` (merged, in word numbers) and ``hit_items`` (sorted ids).

    Input columns of these three names are replaced.  Several blocks of items
    are searched one after the other by the task that holds a shard, and spans
    are united per row.  Beyond ``BLOCKS_A_PASS`` blocks, whose items are what
    a task is sent at once, the documents are written with what was found so
    far and read again for the next ones.
    """
    prepare(docs.sparkSession)
    return _passes(docs, benchmark, window, text_col, item_col, item_text_col, block_bytes, cut=False)


def _shards(batches, most: int):
    """The batches in groups of about ``most`` bytes of memory, one at least."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _passes(docs, benchmark, window, text_col, item_col, item_text_col, block_bytes, cut: bool, blocks_a_pass: int = BLOCKS_A_PASS) -> DataFrame:
    """Every shard is searched for one block of items after the other; with ``cut`` the spans are cut out and the columns of ``docs`` returned."""
    sc = docs.sparkSession.sparkContext
    out = docs if cut else docs.drop(*(n for n, _ in FOUND))
    names, plain = out.columns, out.schema
    found_schema = T.StructType([*plain.fields, *(T.StructField(f"__{n}" if cut else n, t) for n, t in FOUND)])
    blocks = list(_item_blocks(benchmark, item_text_col, item_col, block_bytes))
    for at in range(0, len(blocks), blocks_a_pass):
        sent = [sc.broadcast(block()) for block in blocks[at : at + blocks_a_pass]]
        first, last = at == 0, at + blocks_a_pass >= len(blocks)

        @tidy
        def scan(batches, sent=sent, first=first, last=last):
            only = Windows(sent[0].value, window) if len(sent) == 1 else None
            for shard in _shards(batches, 0 if only else SHARD_BYTES):
                columns = [batch.column(batch.schema.get_field_index(text_col)) for batch in shard]
                texts = [t for column in columns for t in byte_texts(column)]
                found_spans, found_items = [[] for _ in texts], [set() for _ in texts]
                if not first:
                    earlier = [r for batch in shard for r in zip(*(batch.column(len(names) + k).to_pylist() for k in (1, 2)))]
                    found_spans = [[(x["first"], x["last"]) for x in spans] for spans, _ in earlier]
                    found_items = [set(items) for _, items in earlier]
                for block in sent:
                    # One block's windows are held at a time.
                    counts, spans, items = _search(texts, only or Windows(block.value, window))
                    for i, s in spans.items():
                        found_spans[i] = _union(found_spans[i], s)
                    for i, ids in items.items():
                        found_items[i] |= {x for x in ids if x is not None}
                start = 0
                for batch, column in zip(shard, columns):
                    mine = slice(start, start + batch.num_rows)
                    start += batch.num_rows
                    if cut and last:
                        kept = [without_spans(t, s) if s else t for t, s in zip(column.cast(pa.large_binary()).to_pylist(), found_spans[mine])]
                        yield replaced(batch.select(names), text_col, pa.array(kept, pa.large_binary()).cast(pa.large_string()))
                        continue
                    results = [
                        pa.array(counts[mine], pa.int64()),
                        pa.array([[{"first": a, "last": b} for a, b in s] for s in found_spans[mine]], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                        pa.array([sorted(s) for s in found_items[mine]], pa.list_(pa.int64())),
                    ]
                    yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *results], names=found_schema.names)

        out = out.mapInArrow(scan, plain if cut and last else found_schema)
        if not last:
            out = staged(out, "decontamination-pass")  # one Python worker a task, however many passes
    return out


def _union(a, b) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without its words first..last of each span, from the first word's start to the last word's end."""
    flat = np.frombuffer(text.translate(_TABLE), np.uint8)
    edge = np.diff(np.concatenate([[0], (flat != 0x20).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep, at = [], 0
    for first, last in spans:
        keep.append(text[at : starts[first]])
        at = ends[last]
    return b"".join([*keep, text[at:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with every hit span cut out of the text; the columns of ``docs``, all rows kept."""
    prepare(docs.sparkSession)
    return _passes(docs, benchmark, window, text_col, item_col, item_text_col, block_bytes, cut=True)


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    ids = F.array_join(F.array_sort(F.transform("hit_items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, rid, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, row_number() OVER () AS rid,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
), b AS (
  SELECT item_id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark WHERE text IS NOT NULL)
), bw AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g, n
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), m AS (
  SELECT dw.rid, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n
), hits AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid
), its AS (
  SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN its USING (rid)
"""
