"""Personal data: fixed patterns, and identifiers found from contexts learned by bootstrapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.scratch import Scratch
from floodmark.llm.text import apart, chunked, column, cut, joined, running, with_matches

KINDS = ["email", "ip", "card", "phone"]
#: Rounds of scoring; seeds a pattern needs; confidence from which a pattern names new identifiers.
ROUNDS, MIN_SEEDS, MIN_CONFIDENCE = 3, 3, 0.8
#: Digits of a candidate, and characters looked at on each side for its context.
MIN_DIGITS, REACH = 6, 64

# The first class of each pattern is entered at its run's first character or where the last match ended, and repeats
# don't give back: same matches as the plain forms, in linear time and constant stack on any text.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CANDIDATE = r"(?<![0-9A-Za-z])[0-9]++(?:[./-][0-9]++)*+(?![0-9A-Za-z])"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    def value(x, i):
        d = x.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), 0), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """`df` with columns email, ip, card, phone and candidate: spans of the fixed patterns that hold, and of numbers."""
    t = F.col(text)
    digit = t.rlike("[0-9]")
    found = with_matches(df, text, {
        "email": (EMAIL, t.contains("@")), "ip": (IP, digit), "card": (CARD, digit),
        "phone": (PHONE, t.contains("+")), "candidate": (CANDIDATE, digit),
    })
    size = lambda s: F.length(_digits(s["found"]))
    checks = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: s["found"].rlike(rf"^(?:{_PART}\.){{3}}{_PART}$"),
        "card": lambda s: size(s).between(14, 19) & _luhn(_digits(s["found"])),
        "phone": lambda s: size(s).between(10, 15),
        "candidate": lambda s: size(s) >= MIN_DIGITS,
    }
    return found.select(*[column(c) for c in df.columns], *[F.filter(k, f).alias(k) for k, f in checks.items()])


def _context(start: Column, end: Column) -> Column:
    """The word before and the word after in `_chunks`, as two patterns; blank where the text ends.

    Of a word that reaches further than REACH characters, its near end.
    """
    before = cut("_chunks", F.greatest(start - REACH, F.lit(0)), start)
    left = F.lower(F.regexp_extract(before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1))
    right = F.lower(F.regexp_extract(cut("_chunks", end, end + REACH), r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1))
    return F.array(F.concat(F.lit("before "), left), F.concat(F.lit("after "), right))


def occurrences(df: DataFrame, text: str) -> DataFrame:
    """`df` with `base` (spans) and `seen`: array<struct<start, end, found, seed, contexts>> of seeds and candidates."""
    base = base_spans(df, text).withColumn("base", F.concat(*KINDS))
    loose = apart(base, "candidate", "base")
    loose = loose.withColumn("_chunks", F.when(F.size("base") + F.size("candidate") > 0, chunked(F.col(text))))

    def noted(spans, seed):
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"), F.lit(seed).alias("seed"),
            _context(s["start"], s["end"]).alias("contexts")))

    return loose.select(
        *[column(c) for c in df.columns], *KINDS, "base", F.concat(noted("base", True), noted("candidate", False)).alias("seen")
    )


def pattern_confidence(edges: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence, seeds) from edges (pattern, instance, seed), distinct.

    A pattern's confidence is the sum of its instances' scores over their number plus one; a seed scores 1, any other
    instance what its patterns say together (one minus the product of what each leaves open). Patterns with fewer than
    MIN_SEEDS seeds say nothing. Rounds alternate between both sides of the graph.
    """
    counts = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("seed").cast("long")).alias("seeds"))
    known = scratch.keep(edges.join(counts.filter(F.col("seeds") >= MIN_SEEDS), "pattern"))
    scored = known.withColumn("score", F.col("seed").cast("double"))
    for k in range(rounds):
        sums = scored.groupBy("pattern").agg(F.sum("score").alias("sum"), F.first("n").alias("n"), F.first("seeds").alias("seeds"))
        confidence = sums.select("pattern", (F.col("sum") / (F.col("n") + 1)).alias("confidence"), "seeds")
        if k + 1 < rounds:
            open_part = F.sum(F.log1p(-F.col("confidence")))
            loose = known.filter("not seed").join(confidence.drop("seeds"), "pattern")
            score = loose.groupBy("instance").agg((1 - F.exp(open_part)).alias("score"))
            scored = known.join(score, "instance", "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
            scored = scratch.keep(scored)
    return confidence


_EMPTY = "array<struct<start:int,end:int,kind:string>>"


def _named(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(column(text_col), F.lit(""))
    return [column(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text")]


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """One row per row of `docs`: _id, _hash (of the text), base and spans, both array<struct<start, end, kind>>.

    Fixed kinds are e-mail and network addresses, card and phone numbers, each leftmost and non-overlapping; `base` has
    them. They are the seeds: the words before and after them are patterns; numbers of MIN_DIGITS digits and more that
    no seed covers are candidates. A pattern whose confidence reaches `min_confidence` names the candidates beside it;
    `spans` has these too, of kind `context`. Null text counts as empty and has no spans. Rows are told apart by id and
    text, so repeated rows have equal spans, and a null id works as any other. Other columns are not looked at. An empty
    table gives none.

    Text is read once and not shuffled. The graph is summed by pattern and instance before it moves, so a very frequent
    word costs one row per task and instance.
    """
    scratch = Scratch(docs.sparkSession)
    seen = scratch.keep(
        occurrences(docs.select(*_named(docs, id_col, text_col)), "_text").select("_id", "_hash", "base", "seen")
    )
    return _spans(seen, scratch, min_confidence)


def _spans(seen: DataFrame, scratch: Scratch, min_confidence: float) -> DataFrame:
    """:func:`find_personal_data` from the occurrences in each text: _id, _hash, base and seen."""
    each = seen.filter(F.size("seen") > 0).select("_id", "_hash", F.explode("seen").alias("s")).select("_id", "_hash", "s.*")
    linked = each.select(F.explode("contexts").alias("pattern"), F.lower("found").alias("instance"), "seed")
    named = linked.filter("pattern not in ('before ', 'after ')")
    edges = scratch.keep(named.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    trusted = pattern_confidence(edges, scratch).filter(F.col("confidence") >= min_confidence).select("pattern")
    loose = each.filter("not seed").select("_id", "_hash", "start", "end", F.explode("contexts").alias("pattern"))
    span = F.struct("start", "end", F.lit("context").alias("kind"))
    more = loose.join(trusted, "pattern").groupBy("_id", "_hash").agg(F.collect_set(span).alias("more"))
    more = more.select(F.col("_id").alias("i"), F.col("_hash").alias("h"), "more")
    joined_rows = seen.join(more, seen["_id"].eqNullSafe(more["i"]) & (seen["_hash"] == more["h"]), "left")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return joined_rows.select(
        "_id", "_hash", base.alias("base"), F.concat(base, F.coalesce("more", F.array().cast(_EMPTY))).alias("spans")
    )


def _masked(df: DataFrame, text: str, spans: str) -> DataFrame:
    """`df` with each span of the text replaced by its kind in angle brackets; of overlapping spans the rest beyond the first.

    Null spans leave the text as it is.
    """
    placed = df.withColumn("_spans", F.sort_array(spans)).withColumn("_chunks", F.when(F.size(spans) > 0, chunked(F.col(text))))
    placed = placed.withColumn("_reach", F.transform("_spans", lambda s: s["end"]))
    placed = placed.withColumn("_until", running("_reach", F.greatest))
    prior = F.slice(F.concat(F.array(F.lit(0)), F.col("_until")), 1, F.size("_spans"))
    pieces = F.zip_with("_spans", prior, lambda s, at: F.when(s["end"] > at, F.concat(
        cut("_chunks", at, F.greatest(at, s["start"])), F.lit("<"), s["kind"], F.lit(">"))).otherwise(""))
    rest = cut("_chunks", F.get("_until", F.size("_until") - 1), F.char_length(text))
    new = F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col(text))
    return placed.withColumn(text, new).drop("_spans", "_chunks", "_reach", "_until")


def mask_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with each personal span in the text replaced by <kind>. Rows without one, null text too, stay as they are.

    Only texts with a seed or a candidate are shuffled to their spans; all others go from their first table to the result.
    """
    scratch = Scratch(docs.sparkSession)
    held = docs.select(F.struct("*").alias("row"), *_named(docs, id_col, text_col))
    seen = scratch.keep(occurrences(held, "_text").select("row", "_id", "_hash", "base", "seen"))
    spans = _spans(seen.filter(F.size("seen") > 0).select("_id", "_hash", "base", "seen"), scratch, MIN_CONFIDENCE)
    spans = spans.filter(F.size("spans") > 0).dropDuplicates(["_id", "_hash"]).select(
        F.col("_id").alias("i"), F.col("_hash").alias("h"), "spans")
    some = seen.filter(F.size("seen") > 0).select("row", "_id", "_hash")
    both = some.join(spans, some["_id"].eqNullSafe(spans["i"]) & (some["_hash"] == spans["h"]), "left")
    new = _masked(both.select("row", "spans", F.col("row")[text_col].alias("_new")), "_new", "spans").select(
        *[(F.col("_new") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
    return seen.filter(F.size("seen") == 0).select("row.*").unionByName(new)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of find_personal_data: id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("_id").alias(id_col), *map(count, KINDS),
        F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined(F.col("spans"), [*KINDS, "context"]).alias("spans"),
    )
