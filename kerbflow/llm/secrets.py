"""Secret scans with DataFrame functions alone (operator 2)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import put

# The three base patterns and the least length of what counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

SPANS = "array<struct<start: int, end: int, rank: int, kind: string>>"
#: Steps of a prefix sum that are added up one by one, so that its cost stays in proportion to the number of matches.
STRIDE = 256


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are the runs of an alphabet of at least ``window`` characters that hold both a letter and a digit.

    A run is reported if some window of ``window`` characters has an entropy of ``bits`` per character or more.
    """

    kind: str
    alphabet: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.alphabet}]{{{self.window},}}"


#: Entropies are counted in whole millionths of a bit, so that sums are exact whatever their order.
UNIT = 1_000_000
HEX_CLASS = CharacterClass("entropy_hex", "0-9a-fA-F", 32, 3.0)
BASE64_CLASS = CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 4.0)
CLASSES = (HEX_CLASS, BASE64_CLASS)
#: What looks random and is no secret, as whole runs only: UUIDs, the key of the AWS documentation, runs of nothing but placeholder
#: words, and paths of three parts or more that all look like words (no letters of both cases mixed with digits).
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
DOCUMENTED = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
PLACEHOLDER = "(example|sample|placeholder|your|my|api|access|secret|key|token|here|x{4,}|0{4,})[-_=/+]?"
WORD = "^([A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+|[0-9]{1,8})$"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is mentioned."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _placed(text: Column, pattern: str) -> Column:
    """Array of (start, match) of the leftmost matches that do not overlap, in code points.

    The text between the matches comes from a split at the same pattern, so starts are sums of lengths: whole strides
    are added up first, then the rest of a stride.
    """
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def starts(match: Column, gap: Column) -> Column:
        lengths = F.transform(match, lambda m, i: F.length(F.element_at(gap, i + 1)) + F.length(m))

        def with_lengths(steps: Column) -> Column:
            last = F.floor((F.size(match) - 1) / STRIDE).cast("int")
            strides = F.transform(
                F.sequence(F.lit(0), last), lambda s: total(F.slice(steps, s * STRIDE + 1, F.lit(STRIDE)))
            )

            def with_strides(sums: Column) -> Column:
                whole = lambda i: F.floor(i / STRIDE).cast("int")
                before = lambda i: total(F.slice(sums, F.lit(1), whole(i))) + total(
                    F.slice(steps, whole(i) * STRIDE + 1, i % STRIDE)
                )
                return F.transform(
                    match,
                    lambda m, i: F.struct((before(i) + F.length(F.element_at(gap, i + 1))).alias("start"), m.alias("match")),
                )

            return bound(strides, with_strides)

        return bound(lengths, with_lengths)

    none = F.expr("cast(array() as array<struct<start: int, match: string>>)")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bound(
        found,
        lambda match: F.when(F.size(match) == 0, none).otherwise(
            bound(F.split(text, pattern, -1), lambda gap: starts(match, gap))
        ),
    )


def _spans(placed: Column, rank: int, kind: str, keep) -> Column:
    return F.transform(
        F.filter(placed, lambda p: keep(p["match"])),
        lambda p: F.struct(
            p["start"].alias("start"),
            F.lit(rank).alias("rank"),
            (p["start"] + F.length(p["match"])).cast("int").alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def _share(window: int) -> list[int]:
    """c * log2(c) for c characters of a kind in a window, in units."""
    return [0, *(round(c * math.log2(c) * UNIT) for c in range(1, window + 1))]


#: Counts of the printable characters are kept in whole numbers of ten counts, six bits each.
FIRST, HELD, BITS = 33, 10, 6


def entropy_units(match: Column, window: int) -> Column:
    """The least sum of c * log2(c) over the windows of a run; the entropy of a window is log2(window) - sum / window.

    From one window to the next only two counts change: that of the character that leaves falls by one, that of the
    character that enters rises by one. The counts go along as the state, packed, and the sum follows by the two
    differences, so a step costs the same whatever the window. Windows of at most 63 characters.
    """
    if window >= 1 << BITS:
        raise ValueError(f"a window has at most {(1 << BITS) - 1} characters")
    shares = F.array(*[F.lit(s).cast("long") for s in _share(window)])
    share = lambda c: F.element_at(shares, (c + 1).cast("int"))
    place = lambda code: F.floor(code / HELD).cast("int")
    one = lambda code: F.call_function("shiftleft", F.lit(1).cast("long"), (code % HELD * BITS).cast("int"))

    def count(counts: Column, code: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, place(code)), (code % HELD * BITS).cast("int")).bitwiseAND(F.lit((1 << BITS) - 1))

    def changed(counts: Column, code: Column, by: int) -> Column:
        return F.transform(counts, lambda held, k: F.when(k == place(code), held + by * one(code)).otherwise(held))

    def slide(codes: Column) -> Column:
        def step(state: Column, at: Column) -> Column:
            full = at > window

            def without(left: Column) -> Column:
                rises = bound(count(left["counts"], F.element_at(codes, at)), lambda c: share(c + 1) - share(c))
                return bound(
                    left["total"] + rises,
                    lambda t: F.struct(
                        changed(left["counts"], F.element_at(codes, at), 1).alias("counts"),
                        t.alias("total"),
                        F.when(at >= window, F.least(state["least"], t)).otherwise(state["least"]).alias("least"),
                    ),
                )

            leaves = F.element_at(codes, F.greatest(F.lit(1), at - window))
            falls = bound(count(state["counts"], leaves), lambda c: share(c) - share(c - 1))
            left = F.struct(
                F.when(full, changed(state["counts"], leaves, -1)).otherwise(state["counts"]).alias("counts"),
                F.when(full, state["total"] - falls).otherwise(state["total"]).alias("total"),
            )
            return bound(left, without)

        start = F.struct(
            F.array_repeat(F.lit(0).cast("long"), -(-94 // HELD)).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            F.lit(2**62).cast("long").alias("least"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step, lambda s: s["least"])

    return bound(F.transform(F.split(match, ""), lambda c: F.ascii(c) - FIRST), slide)


def harmless(match: Column) -> Column:
    """Whether the allow-list names the whole run, however long it is: paths are tested part by part and word by word."""

    def path(parts: Column) -> Column:
        # An empty first or last part is the slash that a path may begin or end with.
        inner = F.filter(parts, lambda p, i: ~((p == "") & ((i == 0) | (i == F.size(parts) - 1))))
        words = lambda part: F.forall(F.split(part, "[_=-]+", -1), lambda w: w.rlike(WORD))
        return bound(inner, lambda held: (F.size(held) >= 3) & F.forall(held, words))

    only_placeholders = F.regexp_replace(F.lower(match), F.lit(PLACEHOLDER), F.lit("")) == ""
    return match.rlike(UUID) | (match == DOCUMENTED) | only_placeholders | bound(F.split(match, "/", -1), path)


def _random(match: Column, wanted: CharacterClass) -> Column:
    most = round((math.log2(wanted.window) - wanted.bits) * wanted.window * UNIT)
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.when(mixed & ~harmless(match), entropy_units(match, wanted.window) <= most).otherwise(False)


def scan_secrets(docs: DataFrame, text: str = "text", to: str = "secrets", classes: tuple = CLASSES) -> DataFrame:
    """``docs`` with the secrets of each whole text: an array of (start, end, rank, kind), by start, then kind as listed.

    Base kinds are ``assign``, ``access`` and ``hex``: the leftmost matches that do not overlap, of which the short ones are
    dropped afterwards. Each character class adds its runs of high entropy, unless the allow-list (``harmless``) names the whole run; the list
    never removes a base span. Places are code points, the end is exclusive. Null and empty texts have none. A column named
    ``to`` is replaced; other columns and repeated rows stay. All of it runs in the JVM, row by row, without a shuffle.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = [
        _spans(_placed(body, ASSIGN), 0, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LENGTH),
        _spans(_placed(body, ACCESS), 1, "access", lambda m: F.length(m) >= ACCESS_LENGTH),
        # Shorter runs fail whatever follows them, so only runs of the least length are looked for.
        _spans(_placed(body, f"{HEX[:-1]}{{{HEX_LENGTH},}}"), 2, "hex", lambda m: F.lit(True)),
    ]
    added = [_spans(_placed(body, c.pattern), 3 + n, c.kind, lambda m, c=c: _random(m, c)) for n, c in enumerate(classes)]
    # A border: what follows mentions the array often, and it must not be computed for each mention.
    by_kind = F.sort_array(F.concat(*base, *added))
    found = F.transform(by_kind, lambda s: F.struct(s["start"], s["end"], s["rank"], s["kind"]))
    return put(docs, to, found).select(
        F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in [*(c for c in docs.columns if c.lower() != to.lower()), to]])))
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", spans: str = "secrets") -> DataFrame:
    """``docs`` (as ``scan_secrets`` gives them) with each span, or group of spans that touch, replaced by ``mark``."""
    body = F.col(f"`{text}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = (span["start"] > state["at"]) | ((span["start"] == 0) & (state["at"] == 0))
        before = F.concat(state["out"], F.substring(body, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"), F.when(fresh, before).otherwise(state["out"]).alias("out")
        )

    end = lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body)))
    clean = F.when(F.size(F.col(f"`{spans}`")) > 0, F.aggregate(F.col(f"`{spans}`"), start, step, end)).otherwise(body)
    return docs.select(*[clean.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns])
