"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score; SQL functions alone.

A confirmed span starts at its kind's score; a word of its kind within the
``CONTEXT`` code points before it adds to the score, so does a passed
checksum (it is part of the kind's score, as failing spans are dropped).
Everything happens in the row: nothing is shuffled.

Defined cases: a NULL text is searched as empty; repeated rows give repeated
results; other columns, whatever their names, aren't touched; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanmart.llm import native_spans as N

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"
BASE = ("email", "ip", "card", "phone")
#: Score of a confirmed span, and the words that raise it by CONTEXT_GAIN when they stand before it.
KINDS = {
    "email": (0.8, "mail|contact|write"),
    "ip": (0.5, "ip|host|server|address"),
    "card": (0.6, "card|visa|credit|payment"),
    "phone": (0.5, "phone|tel|call|mobile|fax"),
    "iban": (0.8, "iban|account|bank"),
}
CONTEXT = 40
CONTEXT_GAIN = 0.3
CONFIDENT = 0.75


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    reversed_digits = F.split(F.reverse(number), "")
    doubled = F.transform(reversed_digits, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, its first four characters moved to the end and letters as 10 to 35."""
    turned = F.split(F.concat(F.substring(account, 5, 1000), F.substring(account, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(turned, F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97) == 1


def _byte(part: Column) -> Column:
    """Whether a string of digits is at most 255."""
    significant = F.ltrim(part, F.lit("0"))
    return (F.char_length(significant) <= 3) & (F.coalesce(significant.try_cast("int"), F.lit(0)) <= 255)


def pii_spans(text: Column) -> Column:
    """Every confirmed span of a text (NULL: none), by start, then kind as listed."""
    text = F.coalesce(text, F.lit(""))
    length = lambda s: F.char_length(N.digits(s["value"]))
    ip = F.filter(N.spans(text, "ip", 1, IP, needs="."), lambda s: F.forall(F.split(s["value"], r"\."), _byte))
    card = F.filter(N.spans(text, "card", 2, CARD), lambda s: length(s).between(12, 19) & luhn(N.digits(s["value"])))
    phone = F.filter(N.spans(text, "phone", 3, PHONE, needs="+"), lambda s: length(s).between(9, 15))
    iban = F.filter(N.spans(text, "iban", 4, IBAN), lambda s: mod97(s["value"]))
    return N.in_order(N.spans(text, "email", 0, EMAIL, needs="@"), ip, card, phone, iban)


def _score(text: Column, span: Column) -> Column:
    first = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, first + 1, span["start"] - first))
    base = near = None
    for kind, (score, words) in KINDS.items():
        is_kind = span["kind"] == kind
        base = F.when(is_kind, score) if base is None else base.when(is_kind, score)
        near = F.when(is_kind, before.rlike(words)) if near is None else near.when(is_kind, before.rlike(words))
    return F.least(F.lit(1.0), base + F.when(near, CONTEXT_GAIN).otherwise(0.0))


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents plus ``pii``: array of (start, end, kind, value, score); an input column of that name is replaced."""
    docs = docs.drop("pii")
    text = F.coalesce(F.col(text_col), F.lit(""))
    scored = F.transform(
        "__pii",
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"), _score(text, s).alias("score")),
    )
    return docs.withColumn("__pii", pii_spans(F.col(text_col))).withColumn("pii", scored).drop("__pii")


def _count(kind: str) -> Column:
    return F.size(N.of_kinds(F.col("pii"), kind)).cast("long")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(_count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(N.joined(N.of_kinds(F.col("pii"), *BASE)), 256).alias("base_sha256"),
        N.joined(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda s: s["score"] >= CONFIDENT)).cast("long").alias("n_confident"),
    )


def _sql_matches(kind: str, number: int, pattern: str) -> str:
    extract = [f"regexp_extract_all(t, '(?s)(.*?)({pattern})', {g})" for g in (1, 2)]
    return f"SELECT rid, t, '{kind}' AS kind, {number} AS kind_no, {extract[0]} AS gs, {extract[1]} AS ms FROM d"


_SQL_MATCHES = " UNION ALL ".join(
    (
        _sql_matches("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        _sql_matches("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        _sql_matches("card", 2, r"[0-9]([\x20-]?[0-9])+"),
        _sql_matches("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]"),
        _sql_matches("iban", 4, "[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"),
    )
)
_SQL_NEAR = " ".join(f"WHEN '{k}' THEN regexp_matches(b, '{w}')" for k, (_, w) in KINDS.items())
_SQL_SCORE = " ".join(f"WHEN '{k}' THEN {s}::DOUBLE" for k, (s, _) in KINDS.items())

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT rid, t, kind, kind_no, m, regexp_replace(m, '[^0-9]', '', 'g') AS digits,
         sum(length(g) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS e
  FROM (SELECT rid, t, kind, kind_no, unnest(gs) AS g, unnest(ms) AS m, generate_subscripts(ms, 1) AS i FROM ({_SQL_MATCHES}))
), c AS (
  SELECT rid, kind, kind_no, e - length(m) AS s, e, lower(substring(t, (greatest(e - length(m) - {CONTEXT}, 0) + 1)::BIGINT, least({CONTEXT}, e - length(m))::BIGINT)) AS b
  FROM found
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_max(list_transform(string_split(m, '.'), lambda p: p::HUGEINT)) <= 255
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(list_reverse(string_split(digits, '')),
         lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT ELSE (x::INT * 2) % 10 + (x::INT * 2) // 10 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    ELSE list_reduce(list_transform(string_split(m[5:] || m[:4], ''), lambda x: CASE WHEN x BETWEEN '0' AND '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END),
         lambda a, x: (a * (CASE WHEN x > 9 THEN 100 ELSE 10 END) + x) % 97) = 1
    END
), per AS (
  SELECT rid, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) FILTER (kind <> 'iban') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS spans,
         count(*) FILTER (CASE kind {_SQL_SCORE} END + CASE WHEN CASE kind {_SQL_NEAR} END THEN {CONTEXT_GAIN}::DOUBLE ELSE 0 END >= {CONFIDENT}) AS n_confident
  FROM c GROUP BY rid
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_confident, 0) AS n_confident
FROM d LEFT JOIN per USING (rid)
"""
