"""Best-fit packing by sums of squares.

Documents are tokenised once, in their own tasks; only narrow rows (document,
piece, length) take part in the packing.  A piece as long as a sequence is a
sequence by itself.  The others are dealt to groups of about ``group_rows``
rows by a hash of their row number in the written table, so no key, however
often it repeats, makes a large group; each group is packed on its own.

In a group, pieces come in descending length.  Sum-of-squares rule: with
N(g) open sequences whose gap is g, a piece of length l goes into the open
sequence of gap g >= l where the sum of N(g)^2 over 1 <= g < capacity becomes
smallest (it moves from g to g - l); ties go to the smallest gap left.  A new
sequence is opened only where none has room: opening one for the sum's sake
alone took 2 % more sequences on these lengths.

Defined cases: a NULL or empty text has the end token only, so one piece of
length 1; every row is a document of its own, repeated rows too; a NULL id is
kept; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanmart.llm.common import flat_text, prepare, staged, tidy

CAPACITY = 2048
END_TOKEN = 0
GROUP_ROWS = 200_000
#: Words whose ids a worker remembers; when the memory is full, those not met since it was full last are dropped.
CACHE_WORDS = 600_000
#: Bytes of text of one encoding step.
STEP_BYTES = 4 << 20

#: Words that the tokenizer sees as one text, the stretch that stands between them there, and texts of one call.
WORDS_A_TEXT = 512
MARK = b"\x01"
TEXTS_A_CALL = 16

#: ASCII letters, punctuation that the tokenizer always cuts off from a letter before it, and capitals.
_LETTER, _CUT, _UPPER = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_CUT[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_UPPER[0x41:0x5B] = True

_coders: dict[str, "WordCoder"] = {}


class WordCoder:
    """Token ids of texts, from remembered ids of their blank-separated stretches.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its stretches one after the other.  Only ASCII blanks
    cut: other spaces stay inside a stretch and are left to the tokenizer.

    Nor does it join a letter with what is neither letter, digit, space nor
    apostrophe, so a blank between the two changes nothing: one is put there,
    and "word," and "word" share their memory (``cuts``: whether this tokenizer
    is seen to do so).

    New stretches are encoded many at a time with ``MARK`` between them, where
    that is one token; stretches that hold it go alone.  If the tokenizer
    lower-cases, A-Z are lowered before the look-up, except in texts with
    combining marks (U+0300 to U+037F), which compose differently by case.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads of its own each keep memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self._ids([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        letters = bytes(range(0x41, 0x5B)).decode()
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str(letters) == letters.lower()
        signs = bytes(np.flatnonzero(_CUT).astype(np.uint8))
        whole, cut = (self._ids([b" ".join(b"a" + blank + signs[i : i + 1] + b"b" for i in range(len(signs)))])[0] for blank in (b"", b" "))
        self.cuts = np.array_equal(whole, cut)
        self.cut = _CUT.copy()
        for token in self.tokenizer.get_added_tokens_decoder().values():
            # Not inside a special string, which the tokenizer takes as one.
            text = np.frombuffer(token.content.encode(), np.uint8)
            self.cut[text[1:][_LETTER[text[:-1]]]] = False
        self.number: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(1, np.int64)
        self.met = np.zeros(0, bool)

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), TEXTS_A_CALL):
            encoded = self.tokenizer.encode_batch_fast([t.decode() for t in texts[i : i + TEXTS_A_CALL]], add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in encoded]
        return out

    def _forget(self) -> None:
        """Keep the words met since the last time."""
        kept = np.flatnonzero(self.met)
        lengths = np.diff(self.start)[kept]
        ends = np.cumsum(lengths)
        self.flat = self.flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - self.start[kept], lengths)]
        self.start = np.concatenate([[0], ends])
        place = np.full(len(self.met), -1)
        place[kept] = np.arange(len(kept))
        self.number = {w: int(place[i]) for w, i in self.number.items() if place[i] >= 0}
        self.met = np.zeros(len(kept), bool)

    def _learn(self, new: list[bytes]) -> None:
        alone = [w for w in new if self.mark is None or MARK in w]
        apart = set(alone)
        joined = [w for w in new if w not in apart]
        between = b" " + MARK + b" "
        lengths, flat = [], []
        for ids in self._ids([between.join(joined[i : i + WORDS_A_TEXT]) for i in range(0, len(joined), WORDS_A_TEXT)]):
            marks = np.flatnonzero(ids == self.mark)
            lengths.append(np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1)
            flat.append(np.delete(ids, marks))
        for ids in self._ids(alone):
            lengths.append(np.array([len(ids)]))
            flat.append(ids)
        self.flat = np.concatenate([self.flat, *flat])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(lengths))])
        self.number.update(zip(joined + alone, range(len(self.number), len(self.number) + len(new))))

    def _prepared(self, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with A-Z lowered and blanks before cut-off signs: bytes and offsets."""
        if self.lowers:
            upper = np.flatnonzero(_UPPER[flat])
            marks = np.flatnonzero((flat == 0xCC) | (flat == 0xCD))
            if len(marks):
                composed = np.zeros(len(at) - 1, bool)
                composed[np.searchsorted(at, marks, "right") - 1] = True
                upper = upper[~composed[np.searchsorted(at, upper, "right") - 1]]
            if len(upper):
                flat = flat.copy()
                flat[upper] |= 0x20
        if self.cuts and len(flat):
            here = np.flatnonzero(_LETTER[flat[:-1]] & self.cut[flat[1:]]) + 1
            flat = np.insert(flat, here, np.uint8(0x20))
            # A blank at a text's first byte would stand behind the text before: of no effect there.
            at = at + np.searchsorted(here, at, "left")
        return flat, at

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, ``end`` after each, in one array, and where each text begins."""
        if len(self.number) > CACHE_WORDS:
            self._forget()
        flat, at = self._prepared(*flat_text(texts))
        n = len(at) - 1
        whole = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)])
        split = pc.ascii_split_whitespace(whole)
        words_before = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        index = np.array([self.number.get(w, -1) for w in words], np.int64)
        unknown = np.flatnonzero(index < 0)
        if len(unknown):
            new = [words[i] for i in unknown]
            self._learn(new)
            index[unknown] = [self.number[w] for w in new]
            self.met = np.concatenate([self.met, np.zeros(len(self.number) - len(self.met), bool)])
        self.met[index] = True
        index = index[coded.indices.to_numpy()]
        lengths = self.start[index + 1] - self.start[index]
        word_ends = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.flat[np.arange(word_ends[-1]) - np.repeat(word_ends[:-1] - self.start[index], lengths)]
        ends = word_ends[words_before[1:]]
        ids = np.insert(flat, ends, np.uint32(end))
        return ids, np.concatenate([[0], ends + np.arange(1, len(texts) + 1)])


def _coder(path: str) -> WordCoder:
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


def _few(texts: pa.Array, most: int = STEP_BYTES):
    """Ranges of texts of about ``most`` bytes together, so that memory does not follow the batch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = min(len(texts), int(np.searchsorted(ends, before + most, "left")) + 1)
        yield start, stop
        start = stop


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
    id_col: str = "doc_id",
    text_col: str = "text",
    checksum: bool = False,
) -> DataFrame:
    """Per piece: ``id_col``, piece, start, length and ids (little-endian unsigned 32-bit, as binary).

    ``checksum``: instead of the ids their CRC-32 (``ids_crc32``), so that only numbers leave the task.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col))
    last = ("ids_crc32", T.LongType()) if checksum else ("ids", T.BinaryType())
    schema = T.StructType([texts.schema[0], *(T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), last))])
    names = schema.fieldNames()

    def cut(batches):
        coder = _coder(tokenizer_path)
        for batch in batches:
            for a, b in _few(batch.column(1)):
                ids, starts = coder.encode(batch.column(1).slice(a, b - a), end_token)
                lengths = np.diff(starts)
                pieces = -(-lengths // capacity)
                doc = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(lengths[doc] - start, capacity)
                bounds = np.concatenate([starts[doc] + start, ids.shape]).astype(np.int64) * 4
                flat = memoryview(ids.astype("<u4")).cast("B")
                if checksum:
                    found = pa.array([zlib.crc32(flat[i:j]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.int64())
                else:
                    found = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc + a)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), found], names=names
                )

    return texts.mapInArrow(tidy(cut), schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in descending length by the sum-of-squares rule."""
    order = np.argsort(-lengths, kind="stable")
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, np.int64)  # N(g)
    none = np.iinfo(np.int64).max
    made = 0
    for i in order.tolist():
        size = int(lengths[i])
        # a move from gap g to g - size changes the sum by 2 N(g - size) + 1 - (2 N(g) - 1); gap 0 doesn't count
        change = 2 * n[: capacity - size] + 1
        change[:1] = 0
        change = np.where(n[size:capacity] > 0, change - 2 * n[size:capacity] + 1, none)
        best = int(np.argmin(change)) if len(change) else -1
        if best >= 0 and change[best] != none:
            gap = best + size
            place = open_at[gap].pop()
            n[gap] -= 1
        else:
            gap, place, made = capacity, made, made + 1
        sequence[i], offset[i] = place, capacity - gap
        if gap > size:
            open_at[gap - size].append(place)
            n[gap - size] += 1
    return sequence, offset


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, length_col: str = "length") -> DataFrame:
    """The pieces, whatever their other columns, with ``sequence_id`` and ``offset``.

    Lengths must be between 1 and ``capacity``.  The pieces are written once
    (their rows get numbers), whole ones are placed as they are, and the rest
    is dealt to groups.  Input columns of the two names are replaced.
    """
    prepare(pieces.sparkSession)
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    written = staged(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    full = F.col(length_col) == capacity
    short = written.filter(~full)
    groups = max(1, round(short.count() / group_rows))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack(key, rows):
        rows = rows.sort_by([("__row", "ascending")])
        seq, offset = sum_of_squares(rows.column(length_col).to_numpy().astype(np.int64), capacity)
        # even numbers for packed sequences, odd ones for whole pieces
        seq = (seq * groups + key[0].as_py()) * 2
        return rows.select(names).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(offset))

    packed = short.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)).cast("int")).groupBy("__group").applyInArrow(pack, schema)
    whole = written.filter(full).select(*names, (F.col("__row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the documents with their place; ids are reduced to their checksum before anything moves."""
    return pack_pieces(token_pieces(docs, path or tokenizer_path(), capacity, checksum=True), capacity)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
