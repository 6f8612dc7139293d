"""Secrets in text: fixed patterns, and strings whose sliding-window entropy is high."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.text import column, joined, open_parts, with_matches

KINDS = ["assign", "access", "hex"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
# The run is entered at its first character, which gives the same matches in linear time.
HEX = "(?<![0-9a-f])[0-9a-f]{24,}+"
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: Characters of a window, and the entropy in bits that a window must reach in the first class whose pattern fits the
#: string: hexadecimal, letters of one case, letters, words joined by signs, all others. Long words of natural languages
#: stay below 3.5, joined words below 3.9; 20 random characters reach 3.0, 3.6, 4.0, 4.0 and 4.0 on average.
WINDOW = 20
CLASSES = {"^[0-9a-fA-F]+$": 2.9, "^(?:[a-z]+|[A-Z]+)$": 3.6, "^[A-Za-z]+$": 3.9, "^[^0-9]+$": 4.0, "": 3.8}
#: Strings that are no secrets though they look random: UUIDs, integrity hashes, examples, one character repeated.
ALLOWED = [
    "^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$", "^sha(?:1|256|384|512)-", "EXAMPLE", r"^(.)\1*$",
    "^(?:0123456789|1234567890)",
]
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def window_entropy(found: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of the windows of `found`; 0 if it is shorter than one.

    Counts per character move on by one character in and one out, and so does the sum of c log2 c over them; the
    entropy of a window of w characters is log2 w minus that sum over w.
    """
    codes = F.transform(F.regexp_extract_all(found, F.lit("[A-Za-z0-9+/_=-]"), 0), lambda c: F.instr(F.lit(_ALPHABET), c))
    leaving = F.concat(F.array_repeat(F.lit(0), window), codes)
    moves = F.arrays_zip(codes.alias("come"), F.slice(leaving, 1, F.greatest(F.size(codes), F.lit(0))).alias("go"))
    weight = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(0.0)
    zero = F.array_repeat(F.lit(0), len(_ALPHABET))
    start = F.struct(zero.alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(0.0).alias("best"))

    def step(acc, move):
        come, go = move["come"], move["go"]
        old_in = F.get(acc["counts"], come - 1)
        old_out = F.when(go > 0, F.get(acc["counts"], go - 1)).otherwise(0)
        same = come == go
        total = F.when(same, acc["sum"]).otherwise(
            acc["sum"] + weight(old_in + 1) - weight(old_in) + F.when(go > 0, weight(old_out - 1) - weight(old_out)).otherwise(0.0))
        counts = F.transform(acc["counts"], lambda c, i: c + F.when(i == come - 1, 1).otherwise(0) - F.when(i == go - 1, 1).otherwise(0))
        n = acc["n"] + 1
        bits = F.when(n >= window, F.log2(F.lit(float(window))) - total / window).otherwise(0.0)
        return F.struct(counts.alias("counts"), total.alias("sum"), n.alias("n"), F.greatest(acc["best"], bits).alias("best"))

    return F.aggregate(moves, start, step, lambda acc: acc["best"])


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: list[str] | None = None
) -> DataFrame:
    """One row per row of `docs`: id, base and spans (array<struct<start, end, kind, found>>, code points, end exclusive).

    `base` has the fixed kinds, leftmost and non-overlapping per kind: assignments to a secret's name of 6 characters or
    more, access keys of 20, hexadecimal runs of 24. `spans` adds kind `entropy`: in runs of base-64 characters, the
    parts of 20 and more characters that no base span touches, of which some window of 20 reaches the entropy of the
    part's class, unless a pattern of `allowed` finds a match in the whole run. Fixed kinds are never suppressed. Null text counts as
    empty. Null and repeated ids and other columns change nothing; an empty table gives none. Text is read once, whole,
    and not shuffled.
    """
    narrow = docs.select(column(id_col).alias("_id"), F.coalesce(column(text_col), F.lit("")).alias("_text"))
    t = F.col("_text")
    found = with_matches(narrow, "_text", {
        "assign": (ASSIGN, t.contains(":") | t.contains("=")), "access": (ACCESS, t.contains("AKIA")),
        "hex": (HEX, F.lit(True)), "run": (CANDIDATE, F.lit(True)),
    })
    value = lambda s: F.char_length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 6
    base = found.select(
        "_id", "_text", F.filter("assign", value).alias("assign"),
        F.filter("access", lambda s: F.char_length(s["found"]) >= 20).alias("access"), "hex", "run",
    ).withColumn("base", F.concat(*KINDS))
    parts = open_parts(base, "_text", "run", "base", WINDOW, "parts")

    def high(s):
        listed = F.lit(False)
        for pattern in ALLOWED if allowed is None else allowed:
            listed = listed | s["whole"].rlike(pattern)
        least = F.coalesce(*[F.when(s["found"].rlike(pattern), bits) for pattern, bits in CLASSES.items()])
        return ~listed & (F.round(window_entropy(s["found"]), 9) >= least)

    entropy = F.transform(F.filter("parts", high), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit("entropy").alias("kind"), s["found"].alias("found")))
    return parts.select(F.col("_id").alias(id_col), "base", F.concat("base", entropy).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of find_secrets: id, n_assign, n_access, n_hex, base_sha256, spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        column(id_col), *map(count, KINDS), F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined(F.col("spans"), [*KINDS, "entropy"]).alias("spans"),
    )
