"""Property tests: report operators against plain-Python brute force on random texts."""

import json
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chanmart.functions.text import MIN_WORD_CHARS, STOP_WORDS
from chanmart.operators import reports as R

# ASCII whitespace as the split pattern sees it: space, \t, \n, \x0b, \f, \r.
_WS = re.compile(r"[ \t\n\x0b\f\r]+")

PIECES = st.sampled_from(
    ["a", "b", "c", "d", "e", "A", "É", "é", "ß", ".", "%", "_"]
    + [" ", "\t", "\n", "\r", "\x0b", "  ", "with", "http", "t.me", "the", "And"]
)
TEXT = st.lists(PIECES, max_size=30).map("".join)
TEXTS = st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=25)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, texts):
    rows = [(i, 1, None, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "message_id long, channel_id long, message_posted_at timestamp_ntz, message_text string"
    )


def _brute_counts(texts):
    c = Counter()
    for t in texts:
        if t is None:
            continue
        for w in _WS.split(t.lower()):
            if len(w) > MIN_WORD_CHARS and w not in STOP_WORDS:
                c[w] += 1
    return c


@SETTINGS
@given(texts=TEXTS)
def test_product_mentions_match_brute_force(spark, texts):
    got = {r["product_name"]: r["mention_count"] for r in R.product_mentions(_frame(spark, texts)).collect()}
    assert got == dict(_brute_counts(texts))


@SETTINGS
@given(texts=TEXTS, query=st.text(alphabet=st.sampled_from(["a", "e", "é", " ", "t", "h"]), min_size=1, max_size=3))
def test_search_matches_brute_force(spark, texts, query):
    got = sorted(r["message_id"] for r in R.search_messages(_frame(spark, texts), query, limit=1000).collect())
    want = sorted(i for i, t in enumerate(texts) if t is not None and query.lower() in t.lower())
    assert got == want


# JSON values as Python holds them, numbers as the texts they are written as.
NUMBERS = st.from_regex(r"\A-?(0|[1-9][0-9]{0,30})(\.[0-9]{1,6})?([eE][+-]?[0-9]{1,3})?\Z")
STRINGS = st.text(st.sampled_from(list("ab1.0-+eE\"\\/{}[],: \n\x01ns\u00e9\U0001f600")), max_size=12)


class Number(str):
    pass


def _written(value):
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, list):
        return "[" + " , ".join(map(_written, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}: {_written(v)}" for k, v in value.items()) + "}"
    return json.dumps(value)


JSON = st.recursive(
    st.one_of(st.none(), st.booleans(), STRINGS, NUMBERS.map(Number)),
    lambda inner: st.one_of(st.lists(inner, max_size=4), st.dictionaries(STRINGS, inner, max_size=4)),
    max_leaves=12,
)


@SETTINGS
@given(values=st.lists(st.dictionaries(STRINGS, JSON, max_size=5), min_size=1, max_size=40))
def test_normalised_json_keeps_numbers_and_strings(spark, values):
    from chanmart.functions import json_fields as J
    from chanmart.session import allow_duplicate_json_keys

    allow_duplicate_json_keys(spark)
    texts = [_written(v) for v in values]
    # A key given twice: the last one counts.
    texts += ['{"a":[1,2],' + t[1:] if "a" in v else t for t, v in zip(texts, values)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    parsed = J.with_parsed(df, "v", keep=["i"])
    got = {r["i"]: r["n"] for r in parsed.select("i", J.normalized_json(F.col("_doc")).alias("n")).collect()}
    for i, text in enumerate(texts):
        numbers = {"parse_float": Number, "parse_int": Number}
        assert json.loads(got[i], **numbers) == json.loads(text, **numbers)
