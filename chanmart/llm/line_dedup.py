"""Line de-duplication with once-seen and twice-seen Bloom filters.

Three passes over the texts, none of which shuffles a text:

1. each task adds the 64-bit hash of every distinct line key of every
   document to a pair of Bloom filters; the pairs merge by slices;
2. lines whose hash may have been seen twice are counted exactly: each task
   counts its own documents per 128-bit key digest, so a line in a third of
   all documents is one row per task before the shuffle;
3. each task drops the confirmed lines from its own documents.

The confirmed digests are broadcast while they are under ``broadcast_limit``
of them.  Beyond it, and where first occurrences stay, they meet the documents'
suspect lines, as narrow rows (row key, digest, line number): lines that the
filters hold for single are not sent.  What is found comes back by row key, and
only documents that a filter of these keys lets through are shuffled for it.

Defined cases: a NULL or empty text is one empty line; a line of only blanks
has an empty key and is never dropped when ``min_chars`` is 1 or more; a key
repeated inside one document counts as one document; documents are rows, so a
repeated row counts again; an empty table gives an empty result.  Other
columns, whatever their names, pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanmart.llm import bloom
from chanmart.llm.common import byte_texts, prepare, replaced, staged, tidy

BLANKS = b" \t\n\x0b\x0c\r"
BROADCAST_LIMIT = 1_000_000


def line_keys(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """A text's lines and their keys: blanks stripped at both ends, A-Z lower-cased."""
    lines = text.split(b"\n")
    return lines, [x.strip(BLANKS) for x in text.lower().split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _suspects(text: bytes, min_chars: int, twice: np.ndarray, bits: int) -> list[bytes]:
    keys = [k for k in dict.fromkeys(line_keys(text)[1]) if _long_enough(k, min_chars)]
    if not keys:
        return []
    hit = bloom.probe(twice, np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64), bits)
    return [k for k, h in zip(keys, hit) if h]


def lines_of(docs: DataFrame, text_col: str = "text") -> int:
    """Number of lines of all documents, by a scan that shuffles nothing."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.agg(F.coalesce(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1), F.lit(0))).first()[0]


def twice_filter(docs: DataFrame, min_chars: int, text_col: str, bits: int):
    """A broadcast filter of the line keys that may be in two documents or more."""
    texts = docs.select(F.col(text_col).alias("text"))

    @tidy
    def sketch(batches):
        seen = bloom.SeenTwice(bits)
        for batch in batches:
            found = []
            for text in byte_texts(batch.column(0)):
                found.extend(xxhash.xxh3_64_intdigest(k) for k in set(line_keys(text)[1]) if _long_enough(k, min_chars))
            if found:
                seen.add(np.array(found, np.uint64))
        yield bloom.slice_batch(seen)

    return docs.sparkSession.sparkContext.broadcast(bloom.merged_twice(texts.mapInArrow(sketch, bloom.SLICES), bits))


def repeated_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, text_col: str = "text", bits: int | None = None, twice=None) -> DataFrame:
    """Digest and document count of every line key found in at least ``min_docs`` documents."""
    texts = docs.select(F.col(text_col).alias("text"))
    bits = bits or bloom.bits_for(lines_of(docs, text_col))
    twice = twice or twice_filter(docs, min_chars, text_col, bits)

    @tidy
    def count(batches):
        counts: dict[bytes, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["digest", "n"])

        for batch in batches:
            for text in byte_texts(batch.column(0)):
                for key in _suspects(text, min_chars, twice.value, bits):
                    d = _digest(key)
                    counts[d] = counts.get(d, 0) + 1
            if len(counts) > 500_000:
                yield out()
                counts.clear()
        yield out()

    counts = texts.mapInArrow(count, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n_docs"))
    return counts.filter(F.col("n_docs") >= min_docs)


def _kept(text: bytes, hot, first=()) -> tuple[list[bytes], int, int]:
    """Lines that stay, number of lines, number dropped; ``first``: (digest, line number) that stay."""
    lines, keys = line_keys(text)
    memo = {k: _digest(k) for k in set(keys)}
    bad = {k: d for k, d in memo.items() if d in hot}
    if not bad:
        return lines, len(lines), 0
    kept = [x for i, (x, k) in enumerate(zip(lines, keys)) if k not in bad or (bad[k], i) in first]
    return kept, len(lines), len(lines) - len(kept)


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    text_col: str = "text",
    id_col: str = "doc_id",
    bits: int | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The documents with every line found in ``min_docs`` documents dropped, plus ``n_lines`` and ``n_dropped``.

    ``keep_first`` leaves the first occurrence of each such line: the one in
    the document of smallest ``id_col``, then smallest text digest, then the
    smallest line number (all rows equal in id and text keep it).  ``bits``: size
    of the filters (default: by the number of lines).  The two count columns replace input columns of those names.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    bits = bits or bloom.bits_for(lines_of(docs, text_col))
    twice = twice_filter(docs, min_chars, text_col, bits)
    hot = staged(repeated_lines(docs, min_docs, min_chars, text_col, bits, twice).select("digest"), "hot-lines")
    n_hot = hot.count()
    if n_hot <= broadcast_limit and not keep_first:
        known = docs.sparkSession.sparkContext.broadcast(frozenset(bytes(r[0]) for r in hot.toLocalIterator()))
        return _apply(docs, text_col, lambda: known.value)
    return _apply_joined(docs, hot, twice, bits, min_chars, keep_first, text_col, id_col)


def _out_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


def _with_counts(batch, text_col, results, was_null):
    texts = [None if null and not dropped else b"\n".join(kept) for (kept, _, dropped), null in zip(results, was_null)]
    out = replaced(batch, text_col, pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    columns = [*out.columns, pa.array([n for _, n, _ in results], pa.int64()), pa.array([d for _, _, d in results], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=[*out.schema.names, "n_lines", "n_dropped"])


def _apply(docs: DataFrame, text_col: str, hot_of) -> DataFrame:
    @tidy
    def strip(batches):
        hot = hot_of()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            results = [_kept(t, hot) for t in byte_texts(column)]
            yield _with_counts(batch, text_col, results, column.is_null().to_pylist())

    return docs.mapInArrow(strip, _out_schema(docs))


def _row_key(id_: str | None, text: bytes) -> bytes:
    """16 bytes that tell rows apart by id and text: rows equal in both lose the same lines."""
    name = b"" if id_ is None else b"=" + str(id_).encode()
    return hashlib.blake2b(len(name).to_bytes(8, "little") + name + text, digest_size=16).digest()


def suspect_lines(docs: DataFrame, twice, bits: int, min_chars: int = 1, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(key, ord, digest, line) of each document's lines that the filter lets through, each key of it once: its first line."""
    narrow = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("ord"))

    @tidy
    def lines(batches):
        for batch in batches:
            rows, keys, digests, numbers = [], [], [], []
            for i, (text, id_) in enumerate(zip(byte_texts(batch.column(0)), batch.column(1).to_pylist())):
                suspects = _suspects(text, min_chars, twice.value, bits)
                if not suspects:
                    continue
                key, at = _row_key(id_, text), {}
                for j, k in enumerate(line_keys(text)[1]):
                    at.setdefault(k, j)
                rows += [i] * len(suspects)
                keys += [key] * len(suspects)
                digests += map(_digest, suspects)
                numbers += [at[k] for k in suspects]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column(2).take(pa.array(rows, pa.int64())), pa.array(digests, pa.binary()), pa.array(numbers, pa.int64())],
                names=["key", "ord", "digest", "line"],
            )

    return narrow.mapInArrow(lines, f"key binary, ord {narrow.schema['ord'].dataType.simpleString()}, digest binary, line long")


def _key_hash(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64)[::2].copy()


def _key_filter(keys: DataFrame, column: str, bits: int):
    """A broadcast filter of row keys."""

    def add(batches):
        seen = bloom.SeenTwice(bits)
        for batch in batches:
            if batch.num_rows:
                h = _key_hash(batch.column(0).to_pylist())
                seen.add(np.concatenate([h, h]))
        yield bloom.slice_batch(seen)

    return keys.sparkSession.sparkContext.broadcast(bloom.merged_twice(keys.select(column).mapInArrow(add, bloom.SLICES), bits))


def _apply_joined(docs, hot, twice, bits, min_chars, keep_first, text_col, id_col) -> DataFrame:
    """The same result with the confirmed digests joined instead of broadcast."""
    occurrences = suspect_lines(docs, twice, bits, min_chars, text_col, id_col).join(hot, "digest", "left_semi")
    marked = occurrences.withColumn("first", F.lit(False))
    if keep_first:
        least = F.min(F.struct(F.col("ord").isNull().alias("null_last"), "ord", "key", "line"))
        firsts = occurrences.groupBy("digest").agg(least.alias("f")).select("digest", F.col("f.key").alias("fkey"))
        marked = occurrences.join(firsts, "digest").withColumn("first", F.col("key") == F.col("fkey"))
    per_row = marked.dropDuplicates(["key", "digest"]).groupBy("key").agg(F.collect_list(F.struct("digest", "line", "first")).alias("__hot"))
    per_row = staged(per_row.select(F.col("key").alias("__of"), "__hot"), "hot-lines-by-row")
    sent = _key_filter(per_row, "__of", bits)
    names, text_at, id_at = docs.columns, docs.columns.index(text_col), docs.columns.index(id_col)

    def split(batch):
        """Row keys, and which rows may have found lines."""
        ids = batch.column(id_at).cast(pa.string()).to_pylist()
        keys = [_row_key(i, t) for i, t in zip(ids, byte_texts(batch.column(text_at)))]
        return keys, bloom.probe(sent.value, _key_hash(keys), bits) if keys else np.zeros(0, bool)

    @tidy
    def untouched(batches):
        for batch in batches:
            rest = batch.filter(pa.array(~split(batch)[1]))
            results = [_kept(t, ()) for t in byte_texts(rest.column(text_at))]
            yield _with_counts(rest, text_col, results, rest.column(text_at).is_null().to_pylist())

    @tidy
    def touched(batches):
        for batch in batches:
            keys, may = split(batch)
            rows = pa.array(np.flatnonzero(may))
            yield pa.RecordBatch.from_arrays([*batch.take(rows).columns, pa.array(keys, pa.binary()).take(rows)], names=[*names, "__key"])

    @tidy
    def strip(batches):
        for batch in batches:
            column = batch.column(text_at)
            results = []
            for text, hot_list in zip(byte_texts(column), batch.column(len(names)).to_pylist()):
                found = hot_list or []
                results.append(_kept(text, {x["digest"] for x in found}, {(x["digest"], x["line"]) for x in found if x["first"]}))
            yield _with_counts(batch.select(names), text_col, results, column.is_null().to_pylist())

    perhaps = docs.mapInArrow(touched, T.StructType([*docs.schema.fields, T.StructField("__key", T.BinaryType())]))
    joined = perhaps.join(per_row, F.col("__key") == F.col("__of"), "left").select(*names, "__hot")
    return docs.mapInArrow(untouched, _out_schema(docs)).unionByName(joined.mapInArrow(strip, _out_schema(docs)))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, min_docs=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, rid, i, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(32)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, rid, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), hot AS (
  SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10
), marked AS (
  SELECT l.*, h.k IS NOT NULL AS bad FROM lines l LEFT JOIN hot h ON l.k = h.k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad), '')) AS kept_sha256
FROM marked GROUP BY rid
"""
