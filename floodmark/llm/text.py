"""Columns over whole texts, on built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space between words.
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def column(name: str) -> Column:
    """The column of that exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


SPANS = "array<struct<start:int,end:int,kind:string,found:string>>"


#: Characters of a chunk of `chunked`.
CHUNK = 256


def running(values: str, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative `combine` over the array column of that name; log n rounds, each reaching twice as far back."""
    reaches = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda r: r < F.size(values))

    def step(acc, reach):
        back = F.slice(F.concat(F.array_repeat(F.get(acc, F.lit(-1)), reach), acc), 1, F.size(values))
        return F.zip_with(acc, back, lambda x, y: F.when(y.isNull(), x).otherwise(combine(x, y)))

    return F.aggregate(reaches, F.col(values), step)


def chunked(text: Column) -> Column:
    """`text` cut into pieces of CHUNK code points, from which `cut` reads at any place in the same time."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), 0)


def cut(chunks: Column | str, start: Column, end: Column) -> Column:
    """Code points `start` to `end` (exclusive) of a chunked text; what lies beyond its end is left out."""
    first = (start / CHUNK).cast("int")
    here = F.array_join(F.slice(chunks, first + 1, F.ceil(end / CHUNK).cast("int") - first), "")
    return F.substring(here, start - first * CHUNK + 1, end - start)


def with_matches(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """`df` with a column of spans for each kind of `patterns` (pattern, condition on the text that a match needs).

    Leftmost non-overlapping matches in order as array<struct<start, end, kind, found>>; code points, end exclusive. The
    matches come from one pass of the pattern; only texts that have some are split by it too, for the gaps between, and
    offsets are running sums of both. A pattern must not match the empty string.
    """
    none = F.array().cast("array<string>")
    found = df.select("*", *[
        F.when(when, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none).alias(f"_found_{kind}")
        for kind, (pattern, when) in patterns.items()
    ])

    def moves(kind):
        gaps = F.transform(F.split(text, patterns[kind][0], -1), lambda x: F.char_length(x))
        both = F.zip_with(F.slice(gaps, 1, F.size(f"_found_{kind}")), f"_found_{kind}", lambda g, f: g + F.char_length(f))
        return F.when(F.size(f"_found_{kind}") > 0, both).otherwise(F.array().cast("array<int>"))

    def spans(kind):
        def span(found, end):
            start = end - F.char_length(found)
            return F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), found.alias("found"))

        return F.zip_with(f"_found_{kind}", f"_ends_{kind}", span).cast(SPANS)

    moved = found.select("*", *[moves(k).alias(f"_moves_{k}") for k in patterns])
    ended = moved.select("*", *[running(f"_moves_{k}", lambda x, y: x + y).alias(f"_ends_{k}") for k in patterns])
    return ended.select(*[column(c) for c in df.columns], *[spans(k).alias(k) for k in patterns])


def apart(df: DataFrame, spans: str, covers: str) -> DataFrame:
    """`df` with only those of the non-overlapping `spans` that overlap none of `covers`: one sorted sweep, no pairs.

    A span overlaps a cover if the furthest end of all covers that start before its end lies behind its start.
    """
    none = F.lit(None).cast(SPANS[len("array<"):-1])
    ends = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("cover"), F.lit(0).alias("until"), s.alias("span")))
    starts = F.transform(covers, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("cover"), s["end"].alias("until"), none.alias("span")))
    events = df.withColumn("_events", F.sort_array(F.concat(ends, starts)))
    reach = events.withColumn("_reach", F.transform("_events", lambda e: e["until"]))
    until = reach.withColumn("_until", running("_reach", F.greatest))
    free = F.zip_with("_events", "_until", lambda e, u: F.when((e["cover"] == 0) & (u <= e["span"]["start"]), e["span"]))
    return until.withColumn(spans, F.filter(free, F.isnotnull)).drop("_events", "_reach", "_until")


def open_parts(df: DataFrame, text: str, spans: str, covers: str, least: int, name: str) -> DataFrame:
    """`df` with the stretches of `least` characters and more of `spans` that none of `covers` touches.

    `name` is array<struct<start, end, found, whole>>, whole being what the span found. Starts and ends of both are swept
    in order with running numbers of open spans and covers.
    """
    def edge(at, span, cover, nth):
        return F.struct(at.alias("at"), F.lit(span).alias("span"), F.lit(cover).alias("cover"), F.lit(nth).alias("nth"))

    edges = F.flatten(F.concat(
        F.transform(spans, lambda s: F.array(edge(s["start"], 1, 0, 1), edge(s["end"], -1, 0, 0))),
        F.transform(covers, lambda s: F.array(edge(s["start"], 0, 1, 0), edge(s["end"], 0, -1, 0)))))
    swept = df.withColumn("_edges", F.sort_array(F.when(F.size(spans) > 0, edges).otherwise(F.slice(edges, 1, 0))))
    swept = swept.withColumn("_open", running("_edges", lambda x, y: F.struct(
        x["at"].alias("at"), *[(x[f] + y[f]).alias(f) for f in ("span", "cover", "nth")])))
    swept = swept.withColumn("_chunks", F.when(F.size(spans) > 0, chunked(F.col(text))))
    after = F.slice("_open", 2, F.greatest(F.size("_open") - 1, F.lit(0)))
    part = F.zip_with("_open", after, lambda x, y: F.when(
        (x["span"] == 1) & (x["cover"] == 0) & (y["at"] - x["at"] >= least),
        F.struct(x["at"].alias("start"), y["at"].alias("end"), cut("_chunks", x["at"], y["at"]).alias("found"),
                 F.get(spans, x["nth"] - 1)["found"].alias("whole"))))
    return swept.withColumn(name, F.filter(part, F.isnotnull)).drop("_edges", "_open", "_chunks")


def joined(spans: Column, order: list[str]) -> Column:
    """kind:start:end of spans, by start, then kind in that order, comma-joined."""
    kinds = F.array(*map(F.lit, order))
    placed = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"))))
    return F.array_join(F.transform(placed, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"].cast("int")), s["start"].cast("string"), s["end"].cast("string"))), ",")
