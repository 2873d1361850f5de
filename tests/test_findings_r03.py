"""Faults of the third review: work done once, code that the JVM compiles, listings that stay off the driver."""

import re

from pyspark.sql import functions as F

from chanmart.operators import ingest as I
from chanmart.plans import registered as Q
from chanmart.plans import staging as S
from chanmart.sources import lake as LK

# Fixed value: the JVM interprets larger methods.
COMPILED = 8000


def _largest_method(df):
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


def test_classifying_and_staging_are_code_that_the_jvm_compiles(spark):
    files = spark.range(3).select(F.col("id").cast("string").alias("file_path"), F.lit('{"id":1}').alias("value"))
    valid = I.valid_messages(I.classify_messages(files))
    assert _largest_method(valid) < COMPILED
    assert _largest_method(S.stg_telegram_messages(I.with_load_metadata(valid))) < COMPILED


def _tables(spark, folder):
    spark.sql(
        "SELECT id AS event_id, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS ts, id % 3 AS user_id, 'view' AS event_type FROM range(1, 7)"
    ).write.parquet(f"{folder}/events.parquet")
    spark.sql("SELECT id AS doc_id, 'some words here' AS text, 'src7' AS source, 15L AS n_chars FROM range(4)").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_facts_parse_their_messages_once(spark, tmp_path):
    facts = Q.fct_messages(spark, _tables(spark, tmp_path))
    assert "parseJson" not in facts._jdf.queryExecution().optimizedPlan().toString()
    assert facts.count() == 6


def test_images_are_listed_by_tasks(spark, tmp_path):
    names = ["2024-01-01/1.jpg", "2024-01-01/deep/2.PNG", "2024-01-02/3 a.jpeg", "4.jpg", "2024-01-02/.5.jpg.x.tmp", "_old/6.jpg", "2024-01-02/_7.jpg", "2024-01-02/8.gif"]
    for name in names:
        file = tmp_path / "images" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x" * len(name))
    (tmp_path / "images/2024-01-02/9.jpg").touch()
    base = str(tmp_path / "images")
    for dates in (None, ["2024-01-02", "2024-02-02"], ["2024-02-02"]):
        listed = LK.read_images(spark, base, with_content=False, dates=dates)
        read = LK.read_images(spark, base, dates=dates).select("path", "length")
        assert "binaryFile" not in listed._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(listed.select("path", "length").collect()) == sorted(read.collect())
