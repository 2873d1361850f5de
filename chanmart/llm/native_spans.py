"""Spans of regular expressions with their places, by SQL functions alone.

``regexp_extract_all`` gives matches but not where they are.  Each pattern is
therefore run behind a lazily matched gap, anchored at the end of the previous
match (so a failing search is not tried again from every later character):
the gaps' and matches' lengths, summed, are the places.  Offsets count code
points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,kind_no:int,end:int,kind:string,value:string>"


def spans(text: Column, kind: str, kind_no: int, pattern: str, group: int = 0, needs: str | None = None) -> Column:
    """Array of ``SPAN`` of a pattern's leftmost non-overlapping matches.

    ``value`` is the match, or its ``group``.  ``needs`` is a string every
    match holds; texts without it aren't searched.  Repeated groups in
    ``pattern`` must be possessive: others recurse once per repetition.
    """
    wrapped = F.lit(rf"(?s)\G(.*?)({pattern})")
    take = [F.regexp_extract_all(text, wrapped, F.lit(i)) for i in (1, 2, *([2 + group] if group else []))]
    names = ["gap", "match", "value"] if group else ["gap", "match"]
    parts = F.arrays_zip(*(c.alias(n) for c, n in zip(take, names)))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.char_length(part["match"])
        span = F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), end.alias("end"), F.lit(kind).alias("kind"), part["value" if group else "match"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span.cast(SPAN))).alias("out"))

    empty = F.array().cast(f"array<{SPAN}>")
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(empty) if needs else found


def in_order(*arrays: Column) -> Column:
    """All spans by start, then kind as listed."""
    return F.array_sort(F.concat(*arrays))


def joined(spans_: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans_: Column, *kinds: str) -> Column:
    return F.filter(spans_, lambda s: s["kind"].isin(*kinds))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")
