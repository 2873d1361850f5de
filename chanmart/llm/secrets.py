"""Secret scan with corpus-wide ownership frequency, by SQL functions alone.

Texts are searched before anything is shuffled; what is kept of one is narrow (row number, owner,
repository, spans with the SHA-256 of each candidate value).  Candidates are
aggregated by value to the numbers of distinct owners and repositories: first
distinct (value, owner, repository), then per (value, owner), then per value,
each with map-side partial sums, so a value in a third of all documents is
never gathered.  A value found under many owners, or under a few in many
repositories, is a widely copied example; one that stays with its owner and
looks random is live-looking.  Only values seen in more than one repository
are joined back to their rows, hot ones by broadcast (``join_spread``).

Defined cases: a NULL text is searched as empty; a NULL owner or repository is
one owner or repository of its own; every row is a document, so repeated rows
in one repository count once; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanmart.llm import native_spans as N
from chanmart.llm.common import join_spread, prepare, staged

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
PROVIDER = r"gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|-----BEGIN\x20(?:[A-Z]++\x20)?PRIVATE\x20KEY-----"
BASE = ("assign", "access", "hex")
#: A value under so many owners is an example that people copy; so is one of several owners in so many repositories.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 10
#: A live-looking value has letters, digits and so many different characters.
LIVE_CHARACTERS = 8


def secret_spans(text: Column) -> Column:
    """Every candidate of a text (NULL: none), base kinds and provider tokens, in order."""
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(N.spans(text, "assign", 0, ASSIGN, group=2), lambda s: F.char_length(s["value"]) >= 6)
    access = N.spans(text, "access", 1, ACCESS, needs="AKIA")
    return N.in_order(assign, access, N.spans(text, "hex", 2, HEX), N.spans(text, "provider", 3, PROVIDER))


def live_looking(value: Column) -> Column:
    varied = F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & varied


def ownership(candidates: DataFrame) -> DataFrame:
    """Per value: ``n_owners`` and ``n_repositories``; ``candidates`` has value_sha256, owner and repository."""
    pairs = candidates.select("value_sha256", "owner", "repository").distinct()
    by_owner = pairs.groupBy("value_sha256", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("value_sha256").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def is_example(owners: Column, repositories: Column) -> Column:
    """Widely copied: under many owners, or under more than one and in many repositories.  One owner's value is theirs."""
    return (owners >= EXAMPLE_OWNERS) | ((owners > 1) & (repositories >= EXAMPLE_REPOSITORIES))


def scan_secrets(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, ``spans`` (array), ``n_example``, ``n_live`` candidates, and ``most_owners``, ``most_repositories`` of one of its values.

    Candidates that are neither widely copied nor live-looking (placeholders
    such as ``changeme``) are in neither number.
    """
    prepare(docs.sparkSession)
    searched = docs.select(
        *(F.col(c).alias(c) for c in keep),
        F.col(owner_col).cast("string").alias("__owner"),
        F.col(repository_col).cast("string").alias("__repository"),
        secret_spans(F.col(text_col)).alias("__found"),
    )
    narrow = F.transform(
        "__found",
        lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"), s["kind"].alias("kind"), F.sha2(s["value"], 256).alias("value_sha256"), live_looking(s["value"]).alias("live")),
    )
    rows = staged(searched.withColumn("__found", narrow).withColumn("__row", F.monotonically_increasing_id()), "secret-candidates")
    candidates = rows.select("__row", F.col("__owner").alias("owner"), F.col("__repository").alias("repository"), F.explode("__found").alias("c")).select("__row", "owner", "repository", "c.value_sha256", "c.live")
    # Values of one repository alone are under one owner: they need no row of their own.
    seen_again = ownership(candidates).filter((F.col("n_repositories") > 1) | (F.col("n_owners") > 1))
    mine = staged(candidates.groupBy("__row", "value_sha256", "live").agg(F.count(F.lit(1)).alias("n")), "secret-values")
    judged = join_spread(mine, staged(seen_again, "secret-ownership"), "value_sha256")
    one = F.lit(1).cast("long")
    judged = judged.withColumns({c: F.coalesce(c, one) for c in ("n_owners", "n_repositories")})
    judged = judged.withColumn("example", is_example(F.col("n_owners"), F.col("n_repositories")))
    per_row = judged.groupBy(F.col("__row").alias("__of")).agg(
        F.sum(F.when(F.col("example"), F.col("n")).otherwise(0)).alias("n_example"),
        F.sum(F.when(~F.col("example") & F.col("live"), F.col("n")).otherwise(0)).alias("n_live"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repositories").alias("most_repositories"),
    )
    zero = F.lit(0).cast("long")
    return rows.join(per_row, F.col("__row") == F.col("__of"), "left").select(
        *keep, F.col("__found").alias("spans"), *(F.coalesce(c, zero).alias(c) for c in ("n_example", "n_live", "most_owners", "most_repositories"))
    )


def _count(kind: str) -> Column:
    return F.size(N.of_kinds(F.col("spans"), kind)).cast("long")


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        *(_count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(N.joined(N.of_kinds(F.col("spans"), *BASE)), 256).alias("base_sha256"),
        N.joined(F.col("spans")).alias("spans"),
        "n_example",
        "n_live",
        "most_owners",
        "most_repositories",
    )


def _sql_matches(kind: str, number: int, pattern: str, value: int = 2) -> str:
    extract = [f"regexp_extract_all(t, '(?s)(.*?)({pattern})', {g})" for g in (1, 2, value)]
    return f"SELECT rid, doc_id, source, '{kind}' AS kind, {number} AS kind_no, {extract[0]} AS gs, {extract[1]} AS ms, {extract[2]} AS vs FROM d"


_SQL_MATCHES = " UNION ALL ".join(
    (
        _sql_matches("assign", 0, r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 4),
        _sql_matches("access", 1, "AKIA[A-Z0-9]+"),
        _sql_matches("hex", 2, "[0-9a-f]+"),
        _sql_matches("provider", 3, r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|-----BEGIN\x20(?:[A-Z]+\x20)?PRIVATE\x20KEY-----"),
    )
)

OP2_SQL = rf"""
WITH d AS (SELECT doc_id, source, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT rid, doc_id, source, kind, kind_no, g, m, v, sum(length(g) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS e
  FROM (SELECT rid, doc_id, source, kind, kind_no, unnest(gs) AS g, unnest(ms) AS m, unnest(vs) AS v, generate_subscripts(ms, 1) AS i
        FROM ({_SQL_MATCHES}))
), c AS (
  SELECT *, e - length(m) AS s,
         regexp_matches(v, '[A-Za-z]') AND regexp_matches(v, '[0-9]') AND len(list_distinct(string_split(v, ''))) >= 8 AS live
  FROM found
  WHERE CASE kind WHEN 'assign' THEN length(v) >= 6 WHEN 'access' THEN length(m) >= 20 WHEN 'hex' THEN length(m) >= 24 ELSE true END
), owners AS (
  SELECT v, n_owners, n_repositories, n_owners >= 3 OR (n_owners > 1 AND n_repositories >= 10) AS example
  FROM (SELECT v, count(DISTINCT coalesce('x' || source, '')) AS n_owners,
               count(DISTINCT (coalesce('x' || source, '') || ':' || coalesce(doc_id::VARCHAR, ''))) AS n_repositories FROM c GROUP BY v)
), per AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) FILTER (kind <> 'provider') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS spans,
         count(*) FILTER (example) AS n_example, count(*) FILTER (NOT example AND live) AS n_live,
         max(n_owners) AS most_owners, max(n_repositories) AS most_repositories
  FROM c JOIN owners USING (v) GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_example, 0) AS n_example, coalesce(n_live, 0) AS n_live,
       coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
FROM d LEFT JOIN per USING (rid)
"""
