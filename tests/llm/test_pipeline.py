"""The whole pipeline against a plain-Python version of its stages, on small tables with every kind of fault."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from chanmart.llm import packing, toxicity
from chanmart.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _tables(folder):
    rng = np.random.default_rng(50)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 3000, n))
    items = [(k, say(14)) for k in range(5)] + [(5, say(4)), (6, None)]
    rows, labels = [], []
    for i in range(300):
        text = say(60) + ("\n Shared LICENSE line\t" if i % 4 == 0 else "") + "\n" + say(20)
        if i % 5 == 0:
            text += " you idiot filth"
        if i % 9 == 1:
            text += " " + items[i % 5][1].upper() + ", " + say(10)
        if i % 50 == 2:
            text += "\n" + items[5][1]
        rows.append((i, text))
        labels.append((i, 1, int(i % 5 == 0)))
    for i in range(300, 330):  # near and exact copies of texts that are not toxic
        words = rows[(i - 300) // 3 * 5 + 1][1]
        rows.append((i, words if i % 3 == 0 else words + f" edit{i}"))
    rows += [(400, None), (401, ""), (402, None), (403, "!!"), (404, "!!"), (405, say(9000)), (401, "")]
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "lang": ["en"] * len(rows), "source": ["s"] * len(rows), "n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64())})
    pq.write_table(table, folder / "documents.parquet")
    pq.write_table(pa.table({"item_id": [x[0] for x in items], "text": [x[1] for x in items]}), folder / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": [x[0] for x in labels], "quality": [x[1] for x in labels], "toxic": [x[2] for x in labels]}), folder / "labels.parquet")
    return rows, items


def _without_toxic(rows, model):
    weights, intercept = model
    kept = []
    for i, text in rows:
        words = set(re.findall(r"\w+", (text or "").lower()))
        features = {f for w in words for f in toxicity.word_features(w)}
        z = intercept + sum(weights.get(f, 0.0) for f in features)
        if 1 / (1 + np.exp(-z)) < toxicity.THRESHOLD:
            kept.append((i, text))
    return kept


def _without_lines(rows):
    key = lambda line: _lower(line).strip(" \t\n\x0b\x0c\r")
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if not (key(x) and n[key(x)] >= 10))) for i, t in rows]


def _one_of_each(rows):
    ids = sorted({i for i, _ in rows})
    grams = []
    for i, t in rows:
        w = WORD.findall(_lower(t or ""))
        if w:
            grams.append((i, Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))))
    label = {i: i for i in ids}
    for x, (i, a) in enumerate(grams):
        for j, b in grams[:x]:
            both = sum(min(c, b[g]) for g, c in a.items())
            if both >= 0.8 * (a.total() + b.total() - both) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    # One row of each class: its smallest id, of that id's rows the one with the smallest digest of its text.
    first = {}
    for i, t in rows:
        first[i] = min(first.get(i, "g"), hashlib.sha256((t or "").encode()).hexdigest())
    out = {}
    for i, t in rows:
        if label[i] == i and hashlib.sha256((t or "").encode()).hexdigest() == first[i]:
            out.setdefault(i, t)
    return list(out.items())


def _without_items(rows, items):
    windows = set()
    for _, t in items:
        w = WORD.findall(_lower(t or ""))
        windows |= {tuple(w[j : j + 10]) for j in range(max(1, len(w) - 9))} if w else set()
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, t))
            continue
        found = list(WORD.finditer(_lower(t)))
        w = [m[0] for m in found]
        hit = {x for n in {len(g) for g in windows} for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in windows for x in range(j, j + n)}
        for x in sorted(hit, reverse=True):
            end = found[x].end() if x + 1 not in hit else found[x + 1].start()
            t = t[: found[x].start()] + t[end:]
        out.append((i, t))
    return out


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows, items = _tables(tmp_path)
    prepare(spark)
    model = toxicity.trained(spark, str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet"))
    left = _without_toxic(rows, model)
    assert {i for i, _ in rows} - {i for i, _ in left} == set(range(0, 300, 5))  # the toxic ones and no other
    steps = [left, _without_lines(left)]
    steps.append(_one_of_each(steps[-1]))
    steps.append(_without_items(steps[-1], items))
    assert all(a != b for a, b in zip(steps, steps[1:]))  # every stage has work to do
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.tokenizer_path())
    expected = Counter()
    for i, text in steps[-1]:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for p in range(-(-len(ids) // 2048)):
            part = ids[p * 2048 : (p + 1) * 2048]
            expected[(i, p, p * 2048, len(part), zlib.crc32(part.tobytes()))] += 1
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert Counter(zip(out.doc_id, out.piece, out.start, out.length, out.ids_crc32)) == expected
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert list(seq.offset) == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 2048
