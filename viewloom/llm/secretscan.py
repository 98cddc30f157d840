"""Secrets in texts: fixed patterns, and a battery of randomness tests on what they leave.

All steps are built-in expressions. Matches are marked in the text with a character that
no pattern holds, and the marked text is split at it, so that the lengths of the pieces give the spans.

The battery looks at tokens of 16 or more symbols outside the patterns' spans. Each has an inferred
encoding: an alphabet, and what ordinary text looks like in it. Three statistics are taken:

* chi-squared: how evenly the token uses the alphabet;
* runs: how often the token changes between kinds of symbols;
* serial correlation of neighbouring symbols.

Under "drawn evenly from the alphabet" none of the three may be rejected at 0.001. Under "ordinary
text of this length" the first two give p-values, which Fisher's method combines; both depend on the
length, so a short token has little to say. The p-values of all tokens of the corpus go through the
step-up procedure of Benjamini and Hochberg: among the tokens reported, a share of at most ``rate`` is
expected to be ordinary. p-values are rounded up to a grid first, so a histogram decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.operators.columns import computed
from viewloom.session import cut_lineage

MARK, MARK_STAND_IN = "\u0001", "\u0002"
KINDS = ("assign", "access", "hex", "random")
#: The patterns of the contract.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA and a run of any length, 20 characters or more
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{16,}"

#: Encoding: its pattern, alphabet, excess of text over even use, and the shares of symbol changes in
#: random strings and in text. The excess is the alphabet's size times the sum of squared symbol shares
#: of text, less 1.
ENCODINGS = (
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.60, 0.469, 0.10),
    ("letters", r"^([a-z]+|[A-Z]+)$", "abcdefghijklmnopqrstuvwxyz", 0.70, 0.311, 0.65),
    ("base32", r"^[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567", 1.10, 0.305, 0.08),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz", 1.36, 0.401, 0.08),
    ("base64", r"^.*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 2.84, 0.666, 0.12),
)
GRID = 8  # steps of the p-value grid per factor of e
BINS = 4096
TAIL_Z, BOTH_Z = 3.0902, 3.2905  # 0.001 in one tail, in both


def spans(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: start, end (code points) and text of the leftmost matches that don't overlap.

    ``text`` must not hold the mark.
    """
    pieces = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    none = F.array().cast("array<struct<s: bigint, e: bigint, m: string>>")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("inside"), none.alias("found"))

    def step(done: Column, piece: Column) -> Column:
        end = done["at"] + F.length(piece)
        match = F.struct(done["at"].alias("s"), end.alias("e"), piece.alias("m"))
        return F.struct(
            end.alias("at"),
            (~done["inside"]).alias("inside"),
            F.when(done["inside"], F.concat(done["found"], F.array(match))).otherwise(done["found"]).alias("found"),
        )

    return F.aggregate(pieces, zero, step, lambda done: done["found"])


def log_tail(z: Column) -> Column:
    """An upper bound of ln P(N > z), tight for z >= 0; 0 below."""
    bound = -(z * z) / 2 - math.log(math.sqrt(2 * math.pi)) + F.log(4 / (3 * z + F.sqrt(z * z + 8)))
    return F.when(z > 0, F.least(bound, F.lit(0.0))).otherwise(F.lit(0.0))


def _tests(token: Column, alphabet: str, excess: float, change_random: float, change_text: float) -> Column:
    size, letters = len(alphabet), alphabet == "abcdefghijklmnopqrstuvwxyz"
    folded = F.translate(token, "-_", "+/") if size == 64 else F.lower(token)
    symbols = F.split(folded, "")
    n = F.length(folded).cast("double")
    # chi-squared
    squares = F.aggregate(
        F.array_distinct(symbols),
        F.lit(0.0),
        lambda total, c: total + F.pow(n - F.length(F.replace(folded, c, F.lit(""))), F.lit(2.0)),
    )
    chi = squares * size / n - n
    text_z = ((size - 1) + n * excess - chi) / F.sqrt(2.0 * (size - 1) + 4 * excess * n)
    part = 2 / (9 * (size - 1))
    even_z = (F.pow(F.greatest(chi, F.lit(0.0)) / (size - 1), F.lit(1 / 3)) - (1 - part)) / math.sqrt(part)
    # Runs of one kind: digits, upper and lower case and others; or vowels and consonants.
    if letters:
        kinds = F.translate(folded, alphabet, "".join("1" if c in "aeiou" else "0" for c in alphabet))
    else:
        kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(folded, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    changes = (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1).cast("double")  # one symbol per run
    side = 1 if change_random > change_text else -1
    runs_text = side * (changes - (n - 1) * change_text) / F.sqrt((n - 1) * change_text * (1 - change_text))
    runs_even = (changes - (n - 1) * change_random) / F.sqrt((n - 1) * change_random * (1 - change_random))
    # Serial correlation of the symbols' places in the alphabet.
    middle = (size + 1) / 2
    values = F.transform(symbols, lambda c: F.instr(F.lit(alphabet), c) - F.lit(middle))
    correlation = F.aggregate(
        values,
        F.struct(F.lit(0.0).alias("last"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("xy")),
        lambda t, x: F.struct(x.alias("last"), (t["xx"] + x * x).alias("xx"), (t["xy"] + t["last"] * x).alias("xy")),
        lambda t: F.when(t["xx"] > 0, t["xy"] / t["xx"]).otherwise(F.lit(1.0)),
    )
    serial = correlation * F.sqrt(n)
    half = -(log_tail(text_z) + log_tail(runs_text))
    score = half - F.log(1 + half)  # Fisher's method for two p-values, as -ln p
    return F.struct(
        F.least(F.floor(score * GRID), F.lit(BINS)).cast("int").alias("bin"),
        ((even_z <= TAIL_Z) & (F.abs(runs_even) <= BOTH_Z) & (F.abs(serial) <= BOTH_Z)).alias("random"),
    )


def battery(token: Column) -> Column:
    """struct(bin, random): the token's place on the grid of -ln p, and whether it may be random."""
    cases = F
    for _, pattern, *encoding in ENCODINGS:
        cases = cases.when(token.rlike(pattern), _tests(token, *encoding))
    return cases


def _threshold(found: DataFrame, rate: float) -> int:
    """The least bin whose p-value the step-up procedure accepts; beyond all bins if there is none."""
    bins = found.select(F.explode("tokens.bin").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # At most BINS + 1 rows.
    above = F.sum("n").over(Window.orderBy(F.desc("bin")))
    every = F.sum("n").over(Window.partitionBy(F.lit(0)))
    passed = bins.select("bin", above.alias("above"), every.alias("tests")).where(
        F.col("tests") * F.exp(-F.col("bin") / F.lit(float(GRID))) <= F.lit(rate) * F.col("above")
    )
    least = passed.agg(F.min("bin")).first()[0]
    return BINS + 1 if least is None else int(least)


def _overlaps(a: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (a["s"] < b["e"]) & (b["s"] < a["e"]))


def _listed(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["k"]), x["s"].cast("string"), x["e"].cast("string"))))


def _of_kind(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def _count(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda x: x["k"] == kind)).cast("bigint")


def scan(docs: DataFrame, text: str = "text", rate: float = 0.01) -> DataFrame:
    """``docs`` without ``text``, with n_assign, n_access, n_hex, n_random, base_spans, all_spans, base_sha256 and spans.

    Spans are array<struct<s, k, e>>, by start and then kind (1 to 4, as in KINDS); spans and base_sha256 write
    them as kind:start:end. A null text is empty and has no span. Rows that repeat are tested each,
    and count each in the family of tests. Columns of ``docs`` with the names of results are replaced.
    """
    names = ("n_assign", "n_access", "n_hex", "n_random", "base_spans", "all_spans", "base_sha256", "spans")
    kept = [c for c in docs.columns if c != text and c not in names]
    row = docs.select(
        F.struct(*[F.col(c) for c in kept] or [F.lit(0).alias("_none")]).alias("_row"),
        F.translate(F.coalesce(F.col(text), F.lit("")), MARK, MARK_STAND_IN).alias("_text"),
    )
    body = F.col("_text")
    row = computed(row, "_assign", F.filter(spans(body, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6))
    row = computed(row, "_access", spans(body, ACCESS))
    row = computed(row, "_hex", spans(body, HEX))
    base = F.array_sort(F.concat(_of_kind(F.col("_assign"), 1), _of_kind(F.col("_access"), 2), _of_kind(F.col("_hex"), 3)))
    row = computed(row, "base_spans", base)
    row = computed(row, "_tokens", F.filter(spans(body, TOKEN), lambda x: ~_overlaps(x, F.col("base_spans"))))
    tested = F.transform("_tokens", lambda x: F.struct(x["s"].alias("s"), F.lit(4).alias("k"), x["e"].alias("e"), battery(x["m"]).alias("t")))
    row = computed(row, "_tested", tested)
    flat = F.transform("_tested", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["t"]["bin"].alias("bin"), x["t"]["random"].alias("random")))
    # No text from here on: spans only, read twice.
    found = cut_lineage(row.select("_row", "base_spans", flat.alias("tokens")))
    least = _threshold(found, rate)
    random = F.transform(
        F.filter("tokens", lambda x: x["random"] & (x["bin"] >= least)),
        lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")),
    )
    out = found.withColumn("all_spans", F.array_sort(F.concat("base_spans", random)))
    for number, kind in enumerate(KINDS, 1):
        out = out.withColumn(f"n_{kind}", _count(F.col("all_spans"), number))
    out = out.withColumns({"base_sha256": F.sha2(_listed(F.col("base_spans")), 256), "spans": _listed(F.col("all_spans"))})
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], *names)
