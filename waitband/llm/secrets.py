"""Secret scan (operator 7), DataFrame functions only.

Four kinds of spans, all ``kind:start:end`` in code points, end exclusive:

* ``assign``, ``access``, ``hex``: fixed patterns, leftmost and not overlapping
  within a kind;
* ``entropy``: candidate strings of each character class over which a window of
  ``WINDOW`` characters slides.  The window's character counts are kept up to
  date (one comes in, one goes out) and with them the sum of c*log2(c), whose
  distance from the window's log2 is its Shannon entropy; the span runs from
  the first window that reaches the class's threshold to the end of the last.
  Candidates that an allow-list pattern anchored at the start matches are passed
  over.  A hit of another allow-list pattern only stops the windows that overlap
  it: what lies between the hits is gone through piece by piece, each with a span
  of its own.  The fixed patterns' spans are never passed over.

The sums are whole numbers (c*log2(c) in billionths), so that no rounding
drifts along a long candidate.  All of a text is scanned, in one pass per
pattern and without a shuffle.  Null text is empty and has no spans; equal rows
give equal rows; columns beside id and text are ignored by ``scan`` and kept by
``redact``.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, narrow

#: The base patterns and the least length of what they find.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20


@dataclass(frozen=True)
class CharClass:
    """Candidates of one character class: characters, patterns that must all
    occur in a candidate, and the entropy in bits that a window must reach."""
    name: str
    chars: str
    pattern: str
    needs: tuple[str, ...]
    bits: float


CLASSES = (
    CharClass("hex", "0123456789abcdefABCDEF", r"[0-9A-Fa-f]{20,}", ("[0-9]", "[A-Fa-f]"), 3.05),
    CharClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
              r"[A-Za-z0-9+/_=-]{20,}", ("[0-9]", "[A-Z]", "[a-z]"), 3.65),
    # base36 and base32 keys; without a letter after f a candidate is the hex class's
    CharClass("lower", "abcdefghijklmnopqrstuvwxyz0123456789", r"[a-z0-9]{20,}", ("[0-9]", "[g-z]"), 3.4),
    CharClass("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", r"[A-Z0-9]{20,}", ("[0-9]", "[G-Z]"), 3.35),
)
#: Candidates that are known not to be secrets: UUIDs, subresource digests, the alphabet or digits in order, placeholders.
ALLOW = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^sha(1|256|384|512)-",
    r"(?i)abcdefgh|0123456789",
    r"(?i)example|placeholder|changeme|x{6,}",
)
FROM_START = re.compile(r"(\(\?\w+\))?\^")


def weights(window: int) -> list[int]:
    """c * log2(c) in billionths, for 0 to window."""
    return [0] + [round(c * math.log2(c) * 1e9) for c in range(1, window + 1)]


def most(window: int, bits: float) -> int:
    """The largest sum of weights at which a window still has ``bits`` of entropy."""
    return math.floor(window * (math.log2(window) - bits) * 1e9)


def running(values: Column, block: int = 256) -> Column:
    """Sums of what stands before each element.  In blocks, since an array that
    grows by one element at a time is copied each time."""
    def plain(xs: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(xs, start, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]

    def whole(xs: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))
        blocks = F.transform(places, lambda b: F.slice(xs, b * block + 1, F.lit(block)))
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
        return F.flatten(F.zip_with(F.transform(blocks, plain), plain(sums), lambda own, o: F.transform(own, lambda x: x + o)))

    return let(values, lambda xs: F.when(F.size(xs) > block, whole(xs)).otherwise(plain(xs)))


def found(text: Column, pattern: str) -> Column:
    """All matches with their place: array of (start, hit)."""
    def places(hits: Column, gaps: Column) -> Column:
        lens = F.zip_with(gaps, hits, lambda g, h: g + F.char_length(h))
        return F.zip_with(F.zip_with(running(lens), gaps, lambda b, g: b + g), hits, lambda s, h: F.struct(s.alias("start"), h.alias("hit")))

    none = F.array().cast("array<struct<start:bigint,hit:string>>")
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p).cast("long"))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(F.size(hits) > 0, let(
        gaps, lambda g: places(hits, F.slice(g, 1, F.size(hits))))).otherwise(none))


def as_spans(found_: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(found_, lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("kind"), (m["start"] + F.char_length(m["hit"])).alias("end")))


def windows(candidate: Column, cls: CharClass, window: int) -> Column:
    """(first, last) start of the windows of ``candidate`` that reach the
    threshold, 0-based; first is -1 if none does."""
    table = F.array(*[F.lit(w).cast("long") for w in weights(window)])
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(cls.chars), c))
    start = F.struct(F.array_repeat(F.lit(0), len(cls.chars)).alias("n"), F.lit(0).cast("long").alias("sum"),
                     F.lit(0).alias("i"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(a: Column, both: Column) -> Column:
        came, went = both["came"], both["went"]
        was = F.get(a["n"], came - 1)
        gone = F.when(went > 0, F.get(a["n"], went - 1) + F.when(went == came, 1).otherwise(0))
        total = (a["sum"] + F.get(table, was + 1) - F.get(table, was)
                 + F.coalesce(F.get(table, gone - 1) - F.get(table, gone), F.lit(0)))
        here = a["i"] - (window - 1)
        hot = (here >= 0) & (total <= most(window, cls.bits))
        counts = F.transform(a["n"], lambda c, j: c + F.when(j == came - 1, 1).otherwise(0) - F.when(j == went - 1, 1).otherwise(0))
        return F.struct(counts.alias("n"), total.alias("sum"), (a["i"] + 1).alias("i"),
                        F.when(hot & (a["first"] < 0), here).otherwise(a["first"]).alias("first"),
                        F.when(hot, here).otherwise(a["last"]).alias("last"))

    leaving = F.concat(F.array_repeat(F.lit(0), window), codes)
    moves = F.zip_with(codes, F.slice(leaving, 1, F.size(codes)), lambda c, w: F.struct(c.alias("came"), w.alias("went")))
    return F.aggregate(moves, start, step, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def pieces(candidate: Column, hits: tuple[str, ...]) -> Column:
    """What lies between the hits of the patterns: array of (start, piece)."""
    if not hits:
        return F.array(F.struct(F.lit(0).cast("long").alias("start"), candidate.alias("piece")))
    pattern = "|".join(f"(?:{p})" for p in hits)
    long = lambda xs: F.transform(xs, lambda x: F.char_length(x).cast("long"))
    return let(F.split(candidate, pattern, -1), lambda ps: let(
        F.concat(F.regexp_extract_all(candidate, F.lit(pattern), F.lit(0)), F.array(F.lit(""))),
        lambda hs: F.zip_with(running(F.zip_with(long(ps), long(hs), lambda p, h: p + h)), ps, lambda s, p: F.struct(s.alias("start"), p.alias("piece")))))


def entropy_spans(text: Column, cls: CharClass, allow: tuple[str, ...], window: int) -> Column:
    anchored = [p for p in allow if FROM_START.match(p)]
    inside = tuple(p for p in allow if p not in anchored)

    def asked(m: Column) -> Column:
        ok = F.lit(True)
        for need in cls.needs:
            ok = ok & m["hit"].rlike(need)
        for pattern in anchored:
            ok = ok & ~m["hit"].rlike(pattern)
        return ok

    # a candidate's windows are gone through once: the filter below looks at their outcome
    seen = F.flatten(F.transform(F.filter(found(text, cls.pattern), asked), lambda m: F.transform(
        pieces(m["hit"], inside), lambda p: F.struct((m["start"] + p["start"]).alias("at"), windows(p["piece"], cls, window).alias("w")))))
    return F.transform(F.filter(seen, lambda m: m["w"]["first"] >= 0), lambda m: F.struct(
        (m["at"] + m["w"]["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
        (m["at"] + m["w"]["last"] + window).alias("end")))


def with_spans(df: DataFrame, text: Column, into: str, allow: tuple[str, ...] = ALLOW, window: int = WINDOW) -> DataFrame:
    """``df`` with column ``into``: all spans of ``text``, by start, then kind."""
    t = F.coalesce(text, F.lit(""))
    assign = F.filter(found(t, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= ASSIGN_LEAST)
    spans = F.concat(as_spans(assign, "assign"), as_spans(found(t, ACCESS), "access"), as_spans(found(t, HEX), "hex"),
                     *[entropy_spans(t, c, allow, window) for c in CLASSES])
    return df.withColumn(into, F.array_sort(F.array_distinct(spans)))


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per document: counts of the base kinds, SHA-256 of the base
    spans, all spans."""
    rows = narrow(docs, {id_col: "long", text_col: "string"}).toDF("doc_id", "text")
    rows = with_spans(rows, F.col("text"), "spans", allow)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one);
    null texts stay null.  Work grows as text length times spans."""
    name = fresh(docs, "__spans")
    t = F.col(text_col)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        inside = s["start"] < a["at"]
        gap = F.substr(t, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(inside, a["out"]).otherwise(F.concat(a["out"], gap, F.lit(mark))).alias("out"))

    clean = F.aggregate(F.col(name), start, step, lambda a: F.concat(a["out"], F.substr(t, (a["at"] + 1).cast("int"))))
    return with_spans(docs, t, name, allow).withColumn(text_col, F.when(F.size(name) > 0, clean).otherwise(t)).drop(name)
