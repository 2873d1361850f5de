"""Near-duplicate classes by DartMinHash over weighted five-word shingles.

A document is a weighted set: its shingles, each weighted by its number of
occurrences.  An element of weight w is the w unit regions [c, c + 1); every
region has its own stream of darts, a Poisson process in the rank, drawn by
hashing (element, c, dart number), so documents that share a region share its
darts.  A document throws all darts of rank below t / weight with
t = K ln K + 2 K, which fill nearly all K coordinates; documents with a gap
double the rank.  The earliest dart of each coordinate is the signature, and
two signatures agree in a coordinate with the weighted Jaccard similarity of
the documents.  BANDS bands of ROWS coordinates bring documents together (a
pair of similarity 0.8 is missed with probability below 3e-5), and every link
is confirmed on the exact weighted similarity.

Exact copies of a word sequence's shingles meet first, by fingerprint, and
only the smallest id of each goes on.  Buckets with the same members are
searched once.  In a bucket a document is compared with the members of other
components only, so a group of copies costs about one comparison each, and the
links returned are a star per component.  A bucket of more than
``BUCKET_ROWS`` members is split by a hash; one leader of each part's
components meets the other parts' leaders in a next level, as long as levels
shrink.  Then the members outside the bucket's largest component so far are
compared, block by block, with all members of other components, so no link of
the bucket is lost, and a bucket that is one component costs nothing more.
Components of all links are found by repeated smallest-label joins, written
down each round.

Defined cases: texts of one to four words are one shingle; NULL, empty and
wordless texts are linked to nothing, rows with a
NULL id neither (their class is NULL, and ``one_of_each`` keeps them); rows repeating an id are
one document whose links are those of all its rows; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chanmart.llm import bloom
from chanmart.llm.common import byte_texts, few_texts, prepare, staged, tidy
from chanmart.llm.decontaminate import words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
K = BANDS * ROWS
BUCKET_ROWS = 1000
#: Text bytes whose shingles and darts are held at once.
CHUNK_BYTES = 1 << 20


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def unit_elements(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' unit regions (shingle, copy number), sorted within a text, and each one's text."""
    split = [words(t) for t in texts]
    word_hash = {w: xxhash.xxh3_64_intdigest(w) for w in set().union(*split)}
    counts = np.fromiter(map(len, split), np.int64, len(split))
    h = np.fromiter(map(word_hash.__getitem__, chain.from_iterable(split)), np.uint64, int(counts.sum()))
    doc = np.repeat(np.arange(len(texts)), counts)
    total = len(h)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)  # words from here to the text's end
    rolled = np.zeros(total, np.uint64)
    for i in range(SHINGLE):
        part = np.zeros(total, np.uint64)
        part[: max(0, total - i)] = h[i:]
        rolled += np.where(left > i, part * np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)), np.uint64(0))
    starts = (left >= SHINGLE) | (left == np.minimum(counts, SHINGLE)[doc]) & (counts[doc] < SHINGLE)
    shingle, doc = _mix(rolled[starts]), doc[starts]
    order = np.lexsort((shingle, doc))
    shingle, doc = shingle[order], doc[order]
    first = np.ones(len(shingle), bool)
    first[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(shingle))
    copy = at - np.maximum.accumulate(np.where(first, at, 0))
    again = copy > 0
    if again.any():
        shingle = shingle.copy()
        shingle[again] = _mix(shingle[again] + copy[again].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.lexsort((shingle, doc))
        shingle, doc = shingle[order], doc[order]
    return shingle, doc


def dart_signatures(elements: np.ndarray, doc: np.ndarray, n_docs: int, k: int = K) -> np.ndarray:
    """(n_docs, k) array of the earliest dart's rank (a dart's rank names it) per coordinate; 0 in texts without elements."""
    out = np.zeros((n_docs, k), np.uint64)
    weight = np.bincount(doc, minlength=n_docs)
    todo = np.flatnonzero(weight)
    expected = k * math.log(k) + 2 * k
    while len(todo):
        limit = np.zeros(n_docs)
        limit[todo] = expected / weight[todo]
        slot_of = np.zeros(n_docs, np.int64)
        slot_of[todo] = np.arange(len(todo)) * k
        mine = limit[doc] > 0
        e, d = elements[mine], doc[mine]
        rank = np.zeros(len(e))
        number = 0
        keys = []
        while len(e):
            number += 1
            draw = _mix(e + np.uint64(number * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = rank - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            alive = rank <= limit[d]
            e, d, rank, draw = e[alive], d[alive], rank[alive], draw[alive]
            slot = slot_of[d] + (_mix(draw) % np.uint64(k)).astype(np.int64)
            keys.append((slot.astype(np.uint64) << np.uint64(40)) | (rank.view(np.uint64) >> np.uint64(24)))
        key = np.sort(np.concatenate(keys))
        slot = (key >> np.uint64(40)).astype(np.int64)
        least = np.ones(len(key), bool)
        least[1:] = slot[1:] != slot[:-1]
        filled = np.zeros(len(todo) * k, np.uint64)
        filled[slot[least]] = key[least] & np.uint64((1 << 40) - 1)
        filled = filled.reshape(len(todo), k)
        whole = (filled > 0).all(axis=1)
        out[todo[whole]] = filled[whole]
        todo = todo[~whole]
        expected *= 2
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of each band's coordinates."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(rows), 1), np.uint64)
    for i in range(ROWS):
        key = _mix(key ^ rows[:, :, i])
    return key


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document: id, fingerprint of its weighted set (NULL without words) and band keys."""

    @tidy
    def run(batches):
        for batch in batches:
            raw = byte_texts(batch.column(1))
            for a, b in few_texts(raw, CHUNK_BYTES):
                elements, doc = unit_elements(raw[a:b])
                keys = band_keys(dart_signatures(elements, doc, b - a)).astype(np.int64)
                at = np.searchsorted(doc, np.arange(b - a + 1))
                prints = [hashlib.blake2b(elements[at[i] : at[i + 1]].tobytes(), digest_size=16).digest() if at[i + 1] > at[i] else None for i in range(b - a)]
                bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(prints, pa.binary()), bands], names=["id", "print", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).mapInArrow(run, "id long, print binary, bands array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two documents given as sorted unit regions."""
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return min(len(a), len(b)) / max(len(a), len(b))  # an upper bound below the threshold
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def local_components(elements: list[np.ndarray]) -> list[int]:
    """For each document the first one of its component of links within the list."""
    groups: list[list[int]] = []
    for i, e in enumerate(elements):
        near = [g for g in groups if any(similarity(e, elements[j]) >= SIMILARITY for j in g)]
        if near:
            near[0].append(i)
            for g in near[1:]:
                near[0].extend(g)
                groups.remove(g)
        else:
            groups.append([i])
    first = [0] * len(elements)
    for g in groups:
        for j in g:
            first[j] = min(g)
    return first


def _link(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("id", "ascending")])
    ids = rows.column("id").to_pylist()
    first = local_components([np.frombuffer(x, np.uint64) for x in rows.column("elements").to_pylist()])
    return pa.table({"key": pa.array([key[0].as_py()] * len(ids), pa.int64()), "leader": pa.array([ids[i] for i in first], pa.int64()), "id": pa.array(ids, pa.int64())})


def _link_across(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One link from each outside member to each other label that has a member alike."""
    outside = rows.column("outside").to_numpy(zero_copy_only=False)
    ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
    elements = [np.frombuffer(x, np.uint64) for x in rows.column("elements").to_pylist()]
    sizes = np.fromiter(map(len, elements), np.int64, len(elements))
    starts = np.cumsum(sizes) - sizes
    known, place = np.unique(np.concatenate(elements), return_inverse=True)
    mark = np.zeros(len(known), bool)
    leaders, linked = [], []
    for i in np.flatnonzero(outside).tolist():
        mine = place[starts[i] : starts[i] + sizes[i]]
        mark[mine] = True
        both = np.add.reduceat(mark[place], starts, dtype=np.int64)
        mark[mine] = False
        alike = np.flatnonzero((both / (sizes + sizes[i] - both) >= SIMILARITY) & ~outside & (labels != labels[i]))
        for j in alike[np.unique(labels[alike], return_index=True)[1]].tolist():
            leaders.append(int(min(ids[i], ids[j])))
            linked.append(int(max(ids[i], ids[j])))
    return pa.table({"leader": pa.array(leaders, pa.int64()), "id": pa.array(linked, pa.int64())})


def ids_filter(ids: DataFrame, id_col: str):
    """A broadcast Bloom filter over a written table's ids, sized by their number; a test for Arrow batches of them."""
    bits = bloom.bits_for(ids.count())

    def add(batches):
        seen = bloom.SeenTwice(bits)
        for batch in batches:
            h = _mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if len(h):
                seen.add(np.concatenate([h, h]))
        yield bloom.slice_batch(seen)

    parts = ids.select(F.col(id_col).cast("long")).dropna().mapInArrow(add, bloom.SLICES)
    return ids.sparkSession.sparkContext.broadcast(bloom.merged_twice(parts, bits))


def maybe_in(sent, column: pa.Array) -> np.ndarray:
    known = column.is_valid().to_numpy(zero_copy_only=False)
    values = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    return known & bloom.probe(sent.value, _mix(values.view(np.uint64)), len(sent.value) * 8)


def _elements_of(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and unit regions of the documents in ``members``; texts that can't be one aren't shuffled."""
    sent = ids_filter(members, "id")

    @tidy
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(maybe_in(sent, batch.column(0))))
            raw = byte_texts(batch.column(1))
            for a, b in few_texts(raw, CHUNK_BYTES):
                elements, doc = unit_elements(raw[a:b])
                at = np.searchsorted(doc, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([elements[at[i] : at[i + 1]].tobytes() for i in range(b - a)], pa.binary())], names=["id", "elements"])

    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).mapInArrow(run, "id long, elements binary")
    return found.join(members.select("id").distinct(), "id", "left_semi")


def links(docs: DataFrame, sketches: DataFrame, id_col: str, text_col: str, bucket_rows: int) -> DataFrame:
    """(leader, id) links between fingerprints' smallest ids."""
    reps = sketches.filter("id IS NOT NULL AND print IS NOT NULL").groupBy("print").agg(F.min("id").alias("id"), F.min("bands").alias("bands"))
    banded = reps.select("id", F.explode("bands").alias("key")).distinct()
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("members"), F.sum(F.xxhash64("id", F.lit(1)) % 1_000_003).alias("check"))
    buckets = staged(sizes.filter("n > 1").groupBy("n", "members", "check").agg(F.min("key").alias("key")).select("key", "n"), "near-buckets")
    members = staged(banded.join(buckets, "key").select("key", "id", "n"), "near-members")
    elements = staged(_elements_of(docs, members, id_col, text_col).distinct(), "near-elements")  # a row for each set of an id
    large = members.filter(F.col("n") > bucket_rows).select("key", "id")
    found, level, before = None, 0, None
    while True:
        part = F.pmod(F.xxhash64("id", F.lit(level)), F.ceil(F.col("n") / bucket_rows).cast("long"))
        joined = members.withColumn("part", part).join(elements, "id")
        linked = staged(joined.groupBy("key", "part").applyInArrow(_link, "key long, leader long, id long"), "near-links")
        new = linked.filter("leader <> id").select("leader", "id")
        found = new if found is None else found.unionByName(new)
        split = members.filter(F.col("n") > bucket_rows).select("key").distinct()
        leaders = linked.filter("leader = id").select("key", "id").distinct().join(split, "key", "left_semi")
        n = leaders.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        members = staged(leaders.join(n, "key").select("key", "id", "n"), "near-members")
        left = members.count()
        if left == 0 or (before is not None and left > 0.9 * before):
            break
        before, level = left, level + 1
    if large.limit(1).count() == 0:
        return found
    return found.unionByName(links_across(large, components(found), elements, bucket_rows))


def links_across(large: DataFrame, labels: DataFrame, elements: DataFrame, bucket_rows: int) -> DataFrame:
    """The links of split buckets (key, id) between members whose labels still differ.

    Any such pair has a member outside the bucket's largest component.  Those
    outside are dealt to blocks, all members to parts, and each block meets
    each part; a group holds about ``bucket_rows`` of either.
    """
    labelled = large.join(labels.select("id", "label"), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    labelled = staged(labelled, "near-large")
    sizes = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    buckets = sizes.groupBy("key").agg(F.max(F.struct("c", "label")).alias("most"), F.sum("c").alias("n")).filter("n > most.c")
    buckets = buckets.select(
        "key",
        F.col("most.label").alias("largest"),
        F.ceil((F.col("n") - F.col("most.c")) / bucket_rows).cast("int").alias("blocks"),
        F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts"),
    )
    dealt = labelled.join(staged(buckets, "near-open"), "key")
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int")
    outside = dealt.filter("label <> largest").select(
        "key", "id", "label", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("outside")
    )
    others = dealt.select(
        "key", "id", "label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part.alias("part"), F.lit(False).alias("outside")
    )
    met = outside.unionByName(others).join(elements, "id").groupBy("key", "block", "part")
    return staged(met.applyInArrow(_link_across, "leader long, id long"), "near-links")


def components(edges: DataFrame) -> DataFrame:
    """id and the smallest id of its component, for every id in an edge (leader, id)."""
    both = staged(edges.select("leader", "id").unionByName(edges.select(F.col("id").alias("leader"), F.col("leader").alias("id"))).distinct(), "near-edges")
    labels = staged(both.groupBy(F.col("id")).agg(F.least(F.min("leader"), F.col("id")).alias("label")), "near-labels")
    while True:
        theirs = both.join(labels.select(F.col("id").alias("leader"), "label"), "leader").groupBy("id").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        moved = (
            labels.join(theirs, "id")
            .join(jump, "label", "left")
            .select("id", F.col("label").alias("old"), F.least("label", "near", F.coalesce("further", "label")).alias("label"))
        )
        moved = staged(moved, "near-labels")
        labels = moved.select("id", "label")
        if moved.filter("old <> label").limit(1).count() == 0:
            return labels


def shared_ids(sketches: DataFrame) -> DataFrame:
    """(leader, id) links between the fingerprints of an id with several, by their smallest ids."""
    known = sketches.filter("id IS NOT NULL AND print IS NOT NULL")
    several = known.groupBy("id").agg(F.min("print").alias("a"), F.max("print").alias("b")).filter("a <> b").select("id")
    reps = known.groupBy("print").agg(F.min("id").alias("rep"))
    theirs = known.join(several, "id", "left_semi").select("id", "print").distinct().join(reps, "print")
    return theirs.filter("rep <> id").select(F.col("rep").alias("leader"), "id")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: ``id_col`` and ``class_id``, the smallest id among its near copies (itself without any)."""
    prepare(docs.sparkSession)
    sketches = staged(sketch(docs, id_col, text_col), "near-sketches")
    linked = links(docs, sketches, id_col, text_col, bucket_rows)
    labels = components(linked.unionByName(shared_ids(sketches)))
    again = sketches.filter("id IS NOT NULL AND print IS NOT NULL").groupBy("print").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = again.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").filter((F.col("n") > 1) | F.col("label").isNotNull())
    classes = staged(classes.select(F.col("print").alias("p"), F.coalesce("label", "rep").alias("class_id")), "near-classes")
    out = sketches.select("id", "print").join(classes, F.col("print") == F.col("p"), "left")
    return out.select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, that of smallest id, all columns; only rows whose id may go or repeats are shuffled.

    Of several rows of that id the one with the smallest text digest stays.
    Rows without id are in no class and stay.
    """
    classes = near_duplicate_classes(docs, id_col, text_col)
    gone = classes.filter(F.col("class_id") != F.col(id_col)).select(F.col(id_col).cast("long").alias("__gone")).distinct()
    gone = gone.withColumn("__stays", F.lit(False))
    again = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("__gone")).agg((F.count(F.lit(1)) > 1).alias("__stays")).filter("__stays")
    # An id that goes, goes; one that only repeats keeps one row.
    touched = gone.unionByName(again).groupBy("__gone").agg(F.min("__stays").alias("__stays"))
    touched = staged(touched, "near-gone")
    sent = ids_filter(touched.select("__gone"), "__gone")
    at = docs.columns.index(id_col)

    def pick(wanted: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(maybe_in(sent, batch.column(at)) == wanted))

        return docs.mapInArrow(run, docs.schema)

    perhaps = pick(True)
    met = perhaps.join(touched, perhaps[id_col].cast("long") == touched["__gone"], "left").filter(F.coalesce("__stays", F.lit(True)))
    untouched = met.filter(F.col("__stays").isNull()).select(*docs.columns)
    # Each task keeps its own first row of an id before they meet (a limit pushed below the shuffle).
    first = Window.partitionBy("__gone").orderBy(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    one = met.filter("__stays").withColumn("__rank", F.row_number().over(first)).filter("__rank = 1").select(*docs.columns)
    return pick(False).unionByName(untouched).unionByName(one)


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
