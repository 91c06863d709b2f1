"""Chat formatting in budgeted windows, with DataFrame functions alone (operator 10).

A turn is written ``### role: text </turn>`` and a line end. Inside roles and texts the control characters are escaped
by a backslash and a letter, so that none of them is left and the marks cannot occur::

    \\ -> \\b    # -> \\h    < -> \\l    and in roles also    : -> \\c    line feed -> \\n
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.llm.common import written

BUDGET, HISTORY = 512, 128
SYSTEM, TARGET = "system", "assistant"
#: Turns are summed up in runs of so many turn numbers first, so that a very long conversation is not one task's.
RUN = 256
#: Windows begin anew after so many times the room of one.
SEGMENT = 32
# Fixed values of the template, in the order in which they are escaped; they are put back in the opposite order.
TEXT_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", "\\c"), ("\n", "\\n"))
OPEN, COLON, CLOSE = "### ", ": ", " </turn>\n"


def escape(text: Column, pairs: tuple = TEXT_ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs: tuple = TEXT_ESCAPES) -> Column:
    """Every backslash in an escaped text begins a code, so the codes can be put back one after another, ``\\b`` last."""
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def turn_tokens(text: Column) -> Column:
    """Size of a turn for the budget: its words and signs, and three for its marks."""
    return F.regexp_count(text, F.lit(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]")) + 3


def window_starts(turns: Column, room: Column, budget: int) -> Column:
    """Where windows begin in the turns of one segment: an array of ``p`` and ``nth``, in order.

    ``turns`` is an array of ``p`` (prefix sum), ``nth`` and ``tokens``, in order. A window takes turns as long as the prefix
    sum at their end keeps within its room, the whole budget where it begins the conversation, and one turn at least.
    """
    none = F.expr("cast(array() as array<struct<p: bigint, nth: bigint>>)")
    begin = F.struct(F.lit(None).cast("long").alias("full"), none.alias("starts"))

    def step(state: Column, t: Column) -> Column:
        opens = F.coalesce(t["p"] + t["tokens"] > state["full"], F.lit(True))
        full = t["p"] + F.when(t["nth"] == 1, F.lit(budget).cast("long")).otherwise(room)
        start = F.array(F.struct(t["p"].alias("p"), t["nth"].alias("nth")))
        return F.struct(
            F.when(opens, full).otherwise(state["full"]).alias("full"),
            F.when(opens, F.concat(state["starts"], start)).otherwise(state["starts"]).alias("starts"),
        )

    return F.aggregate(turns, begin, step, lambda s: s["starts"])


def plan_windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens: str | None = None,
) -> DataFrame:
    """Turns as they are written: ``conv_id, window, place`` (0 system, 1 history, 2 new), ``nth`` in the conversation, ``role, text``.

    Turns are ordered by number (nulls first), then role, text and tokens; null roles and texts are empty. ``tokens`` names a column with
    the tokens of each turn as it is written (of ``count_tokens``, say); without it ``turn_tokens`` counts them. Null or less
    than one counts as one.

    With P the tokens of all turns before a turn, a window takes new turns from its start on while P at their end is within
    what system turn and history leave of the budget (within the whole budget in the first window, which repeats nothing). So it keeps
    to the budget unless one turn alone is longer than that; such a turn is kept whole. Windows begin anew where P
    reaches a multiple of ``SEGMENT`` times that room, so at most one window in a segment is not full. ``window`` is the number of
    turns before its first new one. A first turn of the role ``system`` is repeated in every later window. So are the last turns
    before a window whose tokens together fit into ``history``.

    Prefix sums are taken over runs of turn numbers and then over the runs, so no conversation is collected: what is, is the
    sizes of the turns of a segment, which holds a bounded number of tokens. Turns meet the windows of their segment, and of the few
    that history can reach, by key; a system turn meets those of all segments, each by itself.
    """
    size = turn_tokens(F.col(f"`{text}`")) if tokens is None else F.col(f"`{tokens}`")
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        (F.coalesce(size, F.lit(3)) if tokens is None else F.greatest(F.lit(1), size)).cast("long").alias("tokens"),
    )
    # Null ids are one conversation; joins need a key that is never null.
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")))
    rows = rows.withColumn("run", F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(2**62))))
    ordered = ("turn", "role", "text", "tokens")
    inside = Window.partitionBy("key", "run").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select(
        "*",
        F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("in_run"),
        F.row_number().over(Window.partitionBy("key", "run").orderBy(*ordered)).alias("nth_in_run"),
    )
    placed = written(placed, "chat-turns")
    runs = placed.groupBy("key", "run").agg(
        F.sum("tokens").alias("run_tokens"),
        F.count("*").alias("run_turns"),
        F.max(F.when((F.col("nth_in_run") == 1) & (F.col("role") == SYSTEM), F.col("tokens"))).alias("opens"),
    )
    before = Window.partitionBy("key").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    first = Window.partitionBy("key").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.select(
        "key",
        "run",
        F.coalesce(F.sum("run_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("run_turns").over(before), F.lit(0)).alias("turns_before"),
        F.sum("run_tokens").over(Window.partitionBy("key")).alias("all_tokens"),
        F.first("opens").over(first).alias("system_tokens"),
    )
    left = F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0))
    known = placed.join(runs, ["key", "run"]).select(
        "key",
        "conv_id",
        "role",
        "text",
        "tokens",
        (F.col("tokens_before") + F.col("in_run")).alias("p"),
        (F.col("turns_before") + F.col("nth_in_run")).alias("nth"),
        F.greatest(F.lit(1).cast("long"), left).alias("room"),
        "all_tokens",
        F.col("system_tokens").isNotNull().alias("has_system"),
    )
    segment = lambda p: F.floor(p / (F.col("room") * SEGMENT))
    known = known.withColumn("segment", segment(F.col("p")))
    known = written(known, "chat-known")
    sizes = known.groupBy("key", "segment").agg(F.sort_array(F.collect_list(F.struct("p", "nth", "tokens"))).alias("turns"), F.max("room").alias("room"))
    starts = sizes.select("key", F.col("segment").alias("to"), window_starts(F.col("turns"), F.col("room"), budget).alias("starts"))
    is_system = (F.col("nth") == 1) & F.col("has_system")
    reach = F.when(is_system, segment(F.col("all_tokens"))).otherwise(segment(F.col("p") + history))
    spread = known.withColumn("system", is_system).withColumn("to", F.explode(F.sequence("segment", reach)))
    # Turns of one conversation may be very many: a segment is a key of its own, and the other side has one row for it.
    met = spread.drop("tokens", "room", "all_tokens", "has_system").join(starts, ["key", "to"])
    own = F.filter("starts", lambda s: (F.col("to") == F.col("segment")) & (s["nth"] <= F.col("nth")))
    later = F.filter("starts", lambda s: (s["nth"] > F.col("nth")) & (F.col("system") | (s["p"] - F.col("p") <= history)))
    shown = lambda place: lambda s: F.struct((s["nth"] - 1).alias("window"), place.alias("place"))
    copies = F.concat(
        F.transform(F.slice(own, -1, 1), shown(F.lit(2))),
        F.transform(later, shown(F.when(F.col("system"), 0).otherwise(1))),
    )
    return met.select("conv_id", F.explode(copies).alias("in"), "nth", "role", "text").select(
        "conv_id", "in.window", "in.place", "nth", "role", "text"
    )


def format_windows(planned: DataFrame) -> DataFrame:
    """One row per window: ``conv_id, window, formatted``, ``loss`` (spans of text under the loss mask, code points, end
    exclusive), ``repeated`` (number of turns at the beginning that were shown before) and ``first_nth``.

    The mask holds the escaped text of new turns of the role ``assistant``; repeated ones are left out, so each is
    learned from once. What is collected is one window, which the budget bounds.
    """
    escaped = planned.withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(COLON)))
    escaped = escaped.withColumn("body", escape(F.col("text")))
    piece = F.struct("nth", "place", "head", "body", (F.col("role") == TARGET).alias("target"))
    rows = escaped.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(piece)).alias("turns"))
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, end: int>>)").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        first = state["at"] + F.length(t["head"])
        span = F.array(F.struct(first.alias("start"), (first + F.length(t["body"])).alias("end")))
        learned = t["target"] & (t["place"] == 2)
        return F.struct(
            (state["at"] + size(t)).alias("at"), F.when(learned, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans")
        )

    return rows.select(
        "conv_id",
        "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("turns", start, step, lambda s: s["spans"]).alias("loss"),
        F.size(F.filter("turns", lambda t: t["place"] < 2)).alias("repeated"),
        F.array_min(F.transform(F.filter("turns", lambda t: t["place"] == 2), lambda t: t["nth"])).alias("first_nth"),
    )


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, **columns: str | None) -> DataFrame:
    """Conversations as windows of formatted text with a loss mask, as a written table. No turns give no windows.

    Extra columns are not read. Repeated rows are turns of their own.
    """
    return written(format_windows(plan_windows(turns, budget, history, **columns)), "chat-windows")


def read_turns(windows: DataFrame) -> DataFrame:
    """Windows with ``turns`` (array of role and text, unescaped), their new turns, from the text and the number of repeated
    turns alone, and with ``loss`` as the texts under the mask, unescaped and joined."""
    parts = F.split(F.col("formatted"), F.lit("\\Q" + CLOSE + "\\E"), -1)
    fresh = F.slice(parts, F.col("repeated") + 1, F.greatest(F.lit(0), F.size(parts) - 1 - F.col("repeated")))

    def turn(part: Column) -> Column:
        colon = F.instr(part, COLON)
        return F.struct(
            unescape(F.substring(part, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(part, colon + len(COLON), F.length(part))).alias("text"),
        )

    masked = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return windows.select(
        "conv_id", "window", "first_nth", "formatted", F.transform(fresh, turn).alias("turns"), F.array_join(masked, "").alias("loss")
    )


def digest_conversations(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: number, SHA-256 and loss of its turns, and formatted characters.

    A digest is of a whole conversation, so its texts meet in one row here.
    """
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    both = read_turns(windows).select(
        "conv_id", "window", F.size("turns").alias("n"), lines.alias("lines"), "loss", F.length("formatted").alias("chars")
    )
    grouped = both.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "n", "lines", "loss", "chars"))).alias("w")
    )
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    total = lambda field: F.aggregate(F.transform("w", lambda x: x[field].cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return grouped.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(joined("lines"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
