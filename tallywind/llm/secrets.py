r"""Secrets in texts: fixed patterns, and a battery of randomness tests with false-discovery control.

Built of DataFrame functions only.

Spans are found by marking matches with two private characters, splitting the text at them and adding up lengths;
these characters, should a text hold them, are read as a third one first, which is in no pattern and as long.

The battery looks at runs of 20 or more characters of ``[A-Za-z0-9+/_=-]`` that hold a digit and a letter. The
encoding is inferred as the smallest alphabet that holds all their characters (hex, base32, base36, base62, base64).
Three tests ask whether the characters could be uniform draws from it: a chi-squared test of symbol counts, a runs test
of the upper against the lower half of the alphabet, and a test of the serial correlation of neighbours; three times the
least of their two-sided values must reach ``ACCEPT``. A run that passes must also be no plausible piece of text, where
letters and digits keep together: the chance that text of its length changes as often between small letter, capital and
digit falls with the length. These chances are subject to the rule of Benjamini and Hochberg at ``FDR`` over all runs of
the table, per length class (powers of two), worked out from a histogram.

Defined results: a null or empty text has no spans and the digest of an empty list; equal rows give equal results; an
empty table gives an empty result. Input columns called like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base, by kind, in the order of the digest. A run of letters bounded by other
# characters reaches its least length or fails as a whole, so that length is part of the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]

RANDOM = r"[A-Za-z0-9+/_=-]{20,}"
FDR = 0.001
ACCEPT = 0.001
#: In text, at most this share of neighbouring characters differ in kind (small letter, capital, digit).
TEXT_CHANGES = 0.15

# Alphabets by encoding, smallest first.
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}

_OPEN, _CLOSE, _PLAIN = "\ue000", "\ue001", "\ue002"


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is worked out once: inside functions of arrays it would be worked out per element."""
    return F.transform(F.array(value), fn)[0]


def match_spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, part) of the leftmost matches that do not overlap, in characters.

    An appended array is copied, so parts are gathered in blocks of about the cube root of their number: n matches cost
    n ** (4/3) copies.
    """
    none = F.expr("cast(array() as array<struct<start:int,end:int,part:string>>)")
    no_starts = F.expr("cast(array() as array<int>)")

    def blocks(parts: Column) -> Column:
        size = 2 * F.ceil(F.cbrt(F.size(parts).cast("double"))).cast("int")  # even: every block begins outside a match
        last = F.floor((F.size(parts) - 1) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(parts, b * size + 1, size))

    def step(state: Column, part: Column) -> Column:
        to = state["at"] + F.length(part)
        span = F.struct(state["at"].alias("start"), to.alias("end"), part.alias("part"))
        found = F.when(state["hit"], F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(to.alias("at"), (~state["hit"]).alias("hit"), found.alias("found"))

    def of_block(block: Column, at: Column) -> Column:
        begin = F.struct(at.alias("at"), F.lit(False).alias("hit"), none.alias("found"))
        return F.aggregate(block, begin, step, lambda state: state["found"])

    def placed(blocks: Column) -> Column:
        lengths = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, part: n + F.length(part)))
        begin = F.struct(F.lit(0).alias("at"), no_starts.alias("starts"))
        after = lambda state, n: F.struct((state["at"] + n).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))
        return F.flatten(F.zip_with(blocks, F.aggregate(lengths, begin, after, lambda state: state["starts"]), of_block))

    def spans(marked: Column) -> Column:
        parts = F.split(marked, f"[{_OPEN}{_CLOSE}]", -1)
        return F.when(F.contains(marked, F.lit(_OPEN)), _let(parts, lambda p: _let(blocks(p), placed))).otherwise(none)

    return _let(F.regexp_replace(text, f"({pattern})", f"{_OPEN}$1{_CLOSE}"), spans)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal Z (fixed values: approximation 26.2.17 of Abramowitz and Stegun)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _extended(spans: Column, **made) -> Column:
    """The structs of an array with more fields."""
    return F.transform(spans, lambda s: reduce(lambda row, kv: row.withField(kv[0], kv[1](s)), made.items(), s))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _neighbours(values: Column, n: Column, fn) -> Column:
    return F.zip_with(F.slice(values, F.lit(1), n - 1), F.slice(values, F.lit(2), n - 1), fn)


def _alphabet(core: Column) -> Column:
    out = F.lit(None).cast("string")
    for letters in reversed(ALPHABETS.values()):
        out = F.when(core.rlike("^[" + letters.replace("-", "\\-") + "]+$"), F.lit(letters)).otherwise(out)
    return out


def _kind(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), F.lit(1)).when(c.rlike("[a-z]"), F.lit(2)).when(c.rlike("[A-Z]"), F.lit(3)).otherwise(F.lit(0))


def tested(spans: Column) -> Column:
    """Candidate spans with p_random, p_text (as tenths of -log10, ``level``) and their length class; others are left out."""
    spans = F.filter(spans, lambda s: s["part"].rlike("[0-9]") & s["part"].rlike("[A-Za-z]"))
    spans = _extended(spans, core=lambda s: F.regexp_replace(s["part"], "=+", ""))
    spans = _extended(spans, alphabet=lambda s: _alphabet(s["core"]), chars=lambda s: F.filter(F.split(s["core"], ""), lambda c: c != ""))
    spans = F.filter(spans, lambda s: s["alphabet"].isNotNull() & (F.size(s["chars"]) > 2))
    spans = _extended(
        spans,
        n=lambda s: F.size(s["chars"]),
        k=lambda s: F.length(s["alphabet"]),
        codes=lambda s: F.transform(s["chars"], lambda c: F.position(c, s["alphabet"]).cast("double")),
        kinds=lambda s: F.transform(s["chars"], _kind),
        squares=lambda s: _sum(
            F.transform(F.array_distinct(s["chars"]), lambda c: F.pow(F.length(s["core"]) - F.length(F.replace(s["core"], c, F.lit(""))), F.lit(2.0)))
        ),
    )
    spans = _extended(
        spans,
        mean=lambda s: _sum(s["codes"]) / s["n"],
        upper=lambda s: _sum(F.transform(s["codes"], lambda c: (2 * c > s["k"]).cast("double"))),
        turns=lambda s: _sum(_neighbours(s["codes"], s["n"], lambda a, b: ((2 * a > s["k"]) != (2 * b > s["k"])).cast("double"))),
        changes=lambda s: _sum(_neighbours(s["kinds"], s["n"], lambda a, b: ((a != b) & (a > 0) & (b > 0)).cast("double"))),
    )
    spans = _extended(
        spans,
        spread=lambda s: _sum(F.transform(s["codes"], lambda c: (c - s["mean"]) * (c - s["mean"]))),
        carried=lambda s: _sum(_neighbours(s["codes"], s["n"], lambda a, b: (a - s["mean"]) * (b - s["mean"]))),
        expected=lambda s: 2 * s["upper"] * (s["n"] - s["upper"]) / s["n"] + 1,
    )
    spans = _extended(
        spans,
        z_counts=lambda s: (s["k"] * s["squares"] / s["n"] - s["n"] - (s["k"] - 1)) / F.sqrt(2.0 * (s["k"] - 1) * (s["n"] - 1) / s["n"]),
        z_runs=lambda s: (s["turns"] + 1 - s["expected"]) / F.sqrt(F.greatest((s["expected"] - 1) * (s["expected"] - 2) / (s["n"] - 1), F.lit(1e-6))),
        z_serial=lambda s: F.when(s["spread"] > 0, (s["carried"] / s["spread"] + 1.0 / s["n"]) * F.sqrt(s["n"].cast("double"))).otherwise(F.lit(99.0)),
        z_text=lambda s: (s["changes"] - 0.5 - TEXT_CHANGES * (s["n"] - 1)) / F.sqrt(TEXT_CHANGES * (1 - TEXT_CHANGES) * (s["n"] - 1)),
    )
    spans = _extended(
        spans,
        p_random=lambda s: F.least(F.lit(1.0), 6 * normal_tail(F.greatest(F.abs(s["z_counts"]), F.abs(s["z_runs"]), F.abs(s["z_serial"])))),
        level=lambda s: F.floor(-10 * F.log10(F.greatest(normal_tail(s["z_text"]), F.lit(1e-30)))).cast("int"),
        size_class=lambda s: F.floor(F.log2(s["n"].cast("double"))).cast("int"),
    )
    return F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["p_random"], s["level"], s["size_class"]))


def plain_text(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), _OPEN + _CLOSE, _PLAIN * 2)


def discovery_levels(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[int, int]:
    """Per length class, the least level at which the share of false discoveries among all runs is held at ``fdr``.

    At most 32 length classes of 301 levels reach the driver.
    """
    runs = docs.select(F.explode(tested(match_spans(plain_text(text), RANDOM))).alias("s"))
    counts = runs.groupBy(F.col("s.size_class").alias("c"), F.col("s.level").alias("level")).count().collect()
    found = {}
    for c in {row["c"] for row in counts}:
        mine = sorted(((row["level"], row["count"]) for row in counts if row["c"] == c), reverse=True)
        total, above = sum(n for _, n in mine), 0
        for level, n in mine:
            above += n
            if total * 10 ** (-level / 10) <= fdr * above:
                found[c] = level
    return found


def scan(df: DataFrame, levels: dict[int, int], text: str = "text") -> DataFrame:
    """``df`` with n_assign, n_access, n_hex, base_sha256, spans (text) and secret_spans (array of kind, start, end).

    A span of the battery that meets one of the base is not added.
    """
    names = {"n_assign", "n_access", "n_hex", "base_sha256", "spans", "secret_spans"}
    kept = [c for c in df.columns if c.lower() not in names]
    rows = df.select(*kept, plain_text(text).alias("_plain"))
    long_value = F.filter(match_spans(F.col("_plain"), ASSIGN), lambda s: F.length(F.regexp_extract(s["part"], f"^{ASSIGN}", 2)) >= ASSIGN_VALUE)
    rows = rows.select(
        *kept,
        long_value.alias("_assign"),
        match_spans(F.col("_plain"), ACCESS).alias("_access"),
        match_spans(F.col("_plain"), HEX).alias("_hex"),
        tested(match_spans(F.col("_plain"), RANDOM)).alias("_random"),
    )
    wanted = F.create_map(*[F.lit(v) for pair in sorted(levels.items()) for v in pair]) if levels else None

    def ranked(spans: str, rank: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(KINDS[rank]).alias("kind"), s["end"].alias("end")))

    base = F.array_sort(F.concat(ranked("_assign", 0), ranked("_access", 1), ranked("_hex", 2)))
    rows = rows.withColumn("_base", base)
    apart = lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    is_secret = (lambda s: (s["p_random"] >= ACCEPT) & (s["level"] >= wanted[s["size_class"]]) & apart(s)) if levels else (lambda s: F.lit(False))
    rows = rows.withColumn("_random", F.filter("_random", is_secret)).withColumn("_all", F.array_sort(F.concat("_base", ranked("_random", 3))))
    digest = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select(
        *kept,
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(digest("_base"), 256).alias("base_sha256"),
        digest("_all").alias("spans"),
        F.transform("_all", lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("secret_spans"),
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span, overlapping ones joined, put in for ``mark``."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        between = F.when(fresh, F.concat(F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], between).alias("out"))

    done = F.aggregate(spans, begin, step)
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substr(text, done["at"] + 1))).otherwise(text)
