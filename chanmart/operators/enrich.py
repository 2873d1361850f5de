"""Image enrichment: which images still need a detector run, running it, loading boxes once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanmart.schemas import DETECTOR_OUTPUT_DDL
from chanmart.sources.lake import file_bytes

# Fixed value: the message id is the image file's stem (``12345.jpg``).
STEM_PATTERN = r"([^/]+)\.[^./]+$"

# Fixed value: the error of an image whose file name is no message id.
BAD_IMAGE_NAME = "bad_image_name"

# A detector takes (image_path, image_bytes) and returns boxes as
# (class_name, confidence, [x1, y1, x2, y2]) tuples.
Detector = Callable[[str, bytes], Iterable[tuple]]
DetectorFactory = Callable[[], Detector]


def image_message_id(path: Column) -> Column:
    """Message id from the file stem; NULL (not an error) when the stem is not an integer."""
    return F.regexp_extract(path, STEM_PATTERN, 1).try_cast("bigint")


def unprocessed_images(images: DataFrame, detections: DataFrame, path_col: str = "path") -> DataFrame:
    """Images with no detection row yet.

    Detected paths are de-duplicated map-side before the anti-join.  As in
    the reference loader, an image whose run produced zero boxes has no row
    and is therefore tried again on the next run.
    """
    done = detections.select(F.col("image_path").alias(path_col)).distinct()
    return images.join(done, path_col, "left_anti").select(*images.columns)


def detect_objects(images: DataFrame, detector_factory: DetectorFactory, path_col: str = "path") -> DataFrame:
    """Run a detector over image rows: one output row per box.

    Rows carry ``path`` and, optionally, ``content``; without ``content`` each
    task reads the bytes of its own images, so only paths are shuffled.  The
    detector is built once per task (``detector_factory`` runs on the
    executor), and images stream through in Arrow batches.  A failing image
    yields one row with ``error`` set instead of failing the job; an image
    with no boxes yields no row.  Output columns: image_path,
    detected_object_class, confidence_score, bounding_box, error.
    """
    has_content = "content" in images.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = detector_factory()
        for pdf in batches:
            out: list[tuple] = []
            contents = pdf["content"] if has_content else [None] * len(pdf)
            for path, content in zip(pdf[path_col], contents):
                try:
                    data = bytes(content) if content is not None else file_bytes(path)
                    for cls, conf, box in detect(path, data):
                        out.append((path, str(cls), float(conf), [float(x) for x in box] if box is not None else None, None))
                except Exception as exc:  # isolate per-image failures
                    out.append((path, None, None, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(
                out,
                columns=["image_path", "detected_object_class", "confidence_score", "bounding_box", "error"],
            )

    cols = [path_col, "content"] if has_content else [path_col]
    return images.select(*cols).mapInPandas(run, DETECTOR_OUTPUT_DDL)


def detected_boxes(detector_output: DataFrame) -> DataFrame:
    """Successful boxes with their message id; images whose stem is not a number are dropped here."""
    ok = detector_output.filter(F.col("error").isNull())
    return ok.select(
        image_message_id(F.col("image_path")).alias("message_id"),
        "image_path",
        "detected_object_class",
        "confidence_score",
        "bounding_box",
    ).filter(F.col("message_id").isNotNull())


def detection_errors(detector_output: DataFrame) -> DataFrame:
    """Per-image failures: detector errors and file names without a numeric id."""
    bad_stem = image_message_id(F.col("image_path")).isNull()
    return (
        detector_output.filter(F.col("error").isNotNull() | bad_stem)
        .select("image_path", F.coalesce(F.col("error"), F.lit(BAD_IMAGE_NAME)).alias("error"))
        .distinct()
    )


DETECTION_KEY = ("image_path", "detected_object_class", "bounding_box")


def append_new_detections(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming boxes not already stored under (image_path, class, box).

    The uniqueness rule treats a NULL box as distinct from everything, so
    NULL-box rows are always new; the others are de-duplicated and anti-joined
    on the three keys (hash-partitioned once on them).
    """
    keys = list(DETECTION_KEY)
    has_box = F.col("bounding_box").isNotNull()
    boxed = incoming.filter(has_box).dropDuplicates(keys)
    stored = existing.filter(has_box).select(*keys)
    new_boxed = boxed.join(stored, keys, "left_anti").select(*incoming.columns)
    return new_boxed.unionByName(incoming.filter(~has_box))


def enrichment_stats(new_detections: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: new detections loaded, images that failed."""
    n_new = new_detections.agg(F.count(F.lit(1)).alias("new_detections"))
    n_err = errors.agg(F.countDistinct("image_path").alias("failed_images"))
    # Two single-row aggregates side by side: a scalar subquery, not a join.
    return n_new.select("new_detections", n_err.scalar().alias("failed_images"))
