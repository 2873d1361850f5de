"""A skipping index for message search: which data files can hold a text with these trigrams.

Beside ``fct_messages`` the build keeps a signature of every data file: a bitmap
of the hashed three-byte sequences of its lower-cased texts, in ``SLICES``
slices of 4 KB.  A search asks the slices of its pattern's trigrams only, and
scans the files that have them all; the scan itself decides, so the result is
that of a full scan.  Of a pattern with wildcards the literal runs between them
must all be in a text; runs shorter than three bytes say nothing.

Signatures are kept by lake date and made anew for dates whose files changed.
Files that no signature covers yet are scanned.  Where more than ``MAX_FILES``
files remain, or no trigram is left to ask for, the table is scanned as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanmart.functions import text as TX
from chanmart.operators import reports as R
from chanmart.sources import snapshots as SN
from chanmart.sources import tables as TB

#: Bytes of a slice: what Spark's bitmap aggregates take.
SLICE_BYTES = 4096
SLICES = 8
MAX_FILES = 10_000
#: Text hashed at a time.
CHUNK = 1 << 20


def trigram_codes(data: np.ndarray) -> np.ndarray:
    """The bit number of each three bytes in a row."""
    d = data.astype(np.uint32)
    packed = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    mixed = (packed * np.uint32(2654435761)) & np.uint32(0xFFFFFFFF)
    return (mixed >> np.uint32(32 - (SLICES * SLICE_BYTES * 8).bit_length() + 1)).astype(np.int64)


def pattern_codes(lowered: str) -> list[int]:
    """Bit numbers that a text must have to match the lower-cased pattern (``%`` and ``_`` wild, ``\\`` escapes)."""
    runs, run = [], ""
    for token in re.findall(r"\\.|.", lowered, re.DOTALL):
        if token in "%_":
            runs, run = [*runs, run], ""
        else:
            run += token[1:] if len(token) == 2 else token
    codes = set()
    for r in [*runs, run]:
        data = np.frombuffer(r.encode("utf-8", "replace"), np.uint8)
        if len(data) >= 3:
            codes |= set(trigram_codes(data).tolist())
    return sorted(codes)


def signatures(messages: DataFrame) -> DataFrame:
    """(lake_date, file, slice, bits) of each data file of ``messages``; ``file`` is folder id, partition folder and name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            days, files = batch.column("lake_date").to_pylist(), batch.column("file").to_pylist()
            texts = batch.column("text").fill_null("").cast(pa.large_binary())
            starts = [i for i in range(len(files)) if i == 0 or files[i] != files[i - 1]] + [len(files)]
            for a, b in zip(starts, starts[1:]):
                bits = held.setdefault((days[a], files[a]), np.zeros(SLICES * SLICE_BYTES * 8, bool))
                for text in texts[a:b]:
                    data = np.frombuffer(text.as_buffer(), np.uint8)
                    # A piece begins with the last two bytes of the one before.
                    for k in range(0, max(len(data) - 2, 0), CHUNK):
                        bits[trigram_codes(data[k : k + CHUNK + 2])] = True
        rows = []
        for (day, file), bits in held.items():
            packed = np.packbits(bits, bitorder="little")
            for s in range(SLICES):
                part = packed[s * SLICE_BYTES : (s + 1) * SLICE_BYTES]
                if part.any() or s == 0:
                    rows.append((day, file, s, part.tobytes()))
        if rows:
            types = [pa.string(), pa.string(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["lake_date", "file", "slice", "bits"])

    place = F.concat_ws("/", SN.ID, F.concat(F.lit("lake_date="), "lake_date"), F.col("_metadata.file_name"))
    named = messages.select("lake_date", place.alias("file"), F.lower("message_text").alias("text"))
    parts = named.mapInArrow(run, "lake_date string, file string, slice int, bits binary")
    # A large file is read by several tasks: their bitmaps are joined.
    return parts.groupBy("lake_date", "file", "slice").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))


def build_search_index(spark: SparkSession, root: str, full: bool = False) -> None:
    """Bring the signatures up to the present version of ``fct_messages``."""
    now = SN.snapshot(spark, root, TB.FCT_MESSAGES)
    covered = {} if full else TB.meta(spark, root, TB.SEARCH_INDEX).get("covered", {})
    live: dict[str, list[str]] = {}
    for i, p in sorted(now.parts()):
        live.setdefault(p, []).append(i)
    changed = sorted(p for p, ids in live.items() if covered.get(p) != ids)
    gone = sorted(set(covered) - set(live))
    if not changed and not gone and TB.table_exists(spark, root, TB.SEARCH_INDEX):
        return
    rows = signatures(_files_of(spark, root, now, [(i, p) for p in changed for i in live[p]]))
    mode = "partitions" if TB.table_exists(spark, root, TB.SEARCH_INDEX) and not full else "overwrite"
    TB.write_table(rows, root, TB.SEARCH_INDEX, mode, ["lake_date"], {"covered": live}, ["slice"], replaced=[*changed, *gone])


def _files_of(spark: SparkSession, root: str, version: SN.Snapshot, parts) -> DataFrame:
    return SN.read_parts(spark, root, TB.FCT_MESSAGES, version, parts, metadata=True)


def candidate_files(spark: SparkSession, root: str, query: str) -> tuple[list[str] | None, int, list[tuple[str, str]]]:
    """(files that may match, number of files known, folders without signatures); None where the table must be scanned."""
    now, index = SN.snapshot(spark, root, TB.FCT_MESSAGES), SN.snapshot(spark, root, TB.SEARCH_INDEX)
    if index is None:
        return None, 0, []
    covered = {(i, p) for p, ids in index.meta["covered"].items() for i in ids}
    open_parts = sorted(now.parts() - covered)
    lowered = spark.range(1).select(F.lower(F.lit(TX.ilike_pattern(query))).alias("p")).first()["p"]
    codes = pattern_codes(lowered)
    if not codes:
        return None, 0, []
    bits = SLICE_BYTES * 8
    table = TB.read_table(spark, root, TB.SEARCH_INDEX)
    known = table.filter("slice = 0").count()
    asked: dict[int, list[int]] = {}
    for c in codes:
        asked.setdefault(c // bits, []).append(c % bits)
    per_slice = F.lit(False)
    for s, places in asked.items():
        has = F.lit(True)
        for p in places:
            byte = F.conv(F.hex(F.substring("bits", p // 8 + 1, 1)), 16, 10).cast("int")
            has = has & (byte.bitwiseAND(F.lit(1 << (p % 8))) != 0)
        per_slice = per_slice | ((F.col("slice") == s) & has)
    hits = table.filter(F.col("slice").isin(list(asked)) & per_slice).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    files = [r["file"] for r in hits.filter(F.col("n") == len(asked)).select("file").limit(MAX_FILES + 1).collect()]
    if len(files) > MAX_FILES:
        return None, known, open_parts
    live = now.parts()
    return [f for f in files if tuple(f.split("/")[:2]) in live], known, open_parts


def search_messages_indexed(spark: SparkSession, root: str, query: str, limit: int = R.SEARCH_LIMIT) -> DataFrame:
    """``search_messages`` over the written facts, reading only files that may match: the same rows."""
    files, _, open_parts = candidate_files(spark, root, query)
    if files is None:
        return R.search_messages(TB.read_table(spark, root, TB.FCT_MESSAGES), query, limit)
    now = SN.snapshot(spark, root, TB.FCT_MESSAGES)
    scanned = SN.read_parts(spark, root, TB.FCT_MESSAGES, now, open_parts)
    if files:
        scanned = scanned.unionByName(SN.read_files(spark, root, TB.FCT_MESSAGES, now, [f.split("/") for f in files]))
    return R.search_messages(scanned, query, limit)
