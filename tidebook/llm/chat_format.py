"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation becomes one or more windows of whole turns. Turns are cut into spans by running
sums of their tokens: a span ends before the turn that would exceed what the budget leaves. A window
is the system turn, then up to ``HISTORY_TURNS`` turns from before the span within
``HISTORY_TOKENS``, then the span. Assistant texts of the span are under the loss mask; what is
repeated never is, so every assistant text is trained on once.

Turns are handled in blocks of ``BLOCK`` turn numbers, which also end spans, so that a conversation
of any length is spread over tasks; the last turns of a block are handed to the next as history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY_TURNS = 4
HISTORY_TOKENS = 256
BLOCK = 256
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"
# The turn markers of the template, and what control strings become inside texts.
START, END = "<|im_start|>", "<|im_end|>\n"
ESCAPES = [("&", "&amp;"), ("<|", "&lt;|")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "&#10;")]
# Tokens that the markers and the role of a turn count for.
TURN_TOKENS = 4
BLANKS = r"[\x20\x09-\x0D]+"

_TURN = "struct<turn:bigint,role:string,text:string>"


def escape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    for plain, escaped in pairs:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    for plain, escaped in reversed(pairs):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def _tokens(turn: Column) -> Column:
    """Words of the text and ``TURN_TOKENS``."""
    words = F.filter(F.split(turn["text"], BLANKS), lambda w: w != "")
    return (F.size(words) + TURN_TOKENS).cast("long")


def _formatted(turn: Column) -> Column:
    return F.concat(F.lit(START), escape(turn["role"], ROLE_ESCAPES), F.lit("\n"), escape(turn["text"]), F.lit(END))


def _blocks(conversations: DataFrame) -> DataFrame:
    """(conv_id, block, turns, before): the turns of every block in order, and the last ones of the
    block before."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))
    late = F.pmod(F.col("turn"), F.lit(BLOCK)) >= BLOCK - HISTORY_TURNS
    places = F.when(
        late, F.array(F.struct(block.alias("block"), F.lit(False).alias("carried")), F.struct((block + 1).alias("block"), F.lit(True).alias("carried")))
    ).otherwise(F.array(F.struct(block.alias("block"), F.lit(False).alias("carried"))))
    placed = turns.withColumn("place", F.explode(places)).select("conv_id", "turn", "role", "text", "place.*")
    turn = F.struct("turn", "role", "text")
    grouped = placed.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.when(~F.col("carried"), turn))).alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("carried"), turn))).alias("before"),
    )
    return grouped.filter(F.size("turns") > 0)


def _with_system(blocks: DataFrame) -> DataFrame:
    """Blocks with ``system``: the conversation's first turn, if its role is the system's."""
    first = blocks.groupBy(F.col("conv_id").alias("c")).agg(
        F.min_by(F.element_at("turns", 1), F.col("block")).alias("first")
    )
    first = first.filter(F.col("first.role") == SYSTEM_ROLE).select("c", F.col("first").alias("system"))
    return blocks.join(first, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")


def _spans(tokens: Column, room: Column) -> Column:
    """For every turn the number of its span: a new one where the running sum would exceed room."""
    start = F.struct(
        F.lit(0).cast("long").alias("used"), F.lit(-1).alias("span"), F.array().cast("array<int>").alias("spans")
    )

    def step(state: Column, n: Column) -> Column:
        opens = (state["span"] < 0) | (state["used"] + n > room)
        span = F.when(opens, state["span"] + 1).otherwise(state["span"])
        return F.struct(
            F.when(opens, n).otherwise(state["used"] + n).alias("used"),
            span.alias("span"),
            F.concat(state["spans"], F.array(span)).alias("spans"),
        )

    return F.aggregate(tokens, start, step, lambda state: state["spans"])


def _history(turns: Column) -> Column:
    """The longest end of a few turns that stays within ``HISTORY_TOKENS``."""
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast(f"array<{_TURN}>").alias("kept"))

    def step(state: Column, turn: Column) -> Column:
        used = state["used"] + _tokens(turn)
        return F.struct(
            used.alias("used"),
            F.when(used <= HISTORY_TOKENS, F.concat(F.array(turn), state["kept"])).otherwise(state["kept"]).alias("kept"),
        )

    return F.aggregate(F.reverse(turns), start, step, lambda state: state["kept"])


def _loss(turns: Column, n_repeated: Column) -> Column:
    """Character spans [start, end) of the target texts in the concatenated turns."""
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("place"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    )

    def step(state: Column, turn: Column) -> Column:
        whole = F.length(_formatted(turn))
        end = state["at"] + whole - len(END)
        span = F.struct((end - F.length(escape(turn["text"]))).alias("start"), end.alias("end"))
        target = (turn["role"] == TARGET_ROLE) & (state["place"] >= n_repeated)
        return F.struct(
            (state["at"] + whole).alias("at"),
            (state["place"] + 1).alias("place"),
            F.when(target, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def chat_windows(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """One row per window: conv_id, block, span, text, n_repeated, loss_spans, n_tokens.

    ``conversations`` has conv_id, turn, role, text. Windows of a conversation are ordered by block
    and span. ``text`` is the turns in the template, control strings in roles and texts escaped;
    the first ``n_repeated`` turns stand in an earlier window too. ``loss_spans`` are [start, end)
    in characters of ``text``. A window exceeds the budget only if its span is a single turn that
    does, with what is repeated. Null roles and texts are empty; turns are ordered by number, null
    first, then role and text, and repeated rows are turns of their own; null conversation ids are
    one conversation. The first turn is the system turn if its role is ``system``, others of that
    role are ordinary. Other columns are ignored. An empty table has no windows.
    """
    blocks = _with_system(_blocks(conversations))
    is_system = (F.col("system").isNotNull()) & (F.element_at("turns", 1) == F.col("system"))
    blocks = blocks.select(
        "conv_id", "block", "turns", "system", is_system.alias("opens"),
        F.filter("before", lambda t: ~t.eqNullSafe(F.col("system"))).alias("before"),
        F.transform("turns", _tokens).alias("tokens"),
        F.coalesce(_tokens(F.col("system")), F.lit(0)).alias("system_tokens"),
    )
    # The system turn stands before every span; in the first it is a part of it.
    room = F.lit(budget - HISTORY_TOKENS) - F.col("system_tokens")
    spans = blocks.withColumn("spans", _spans(F.col("tokens"), room))
    rows = spans.withColumn("span", F.explode(F.array_distinct("spans")))
    first = F.array_position("spans", F.col("span")).cast("int")
    count = F.size(F.filter("spans", lambda s: s == F.col("span")))
    rows = rows.withColumn("first", first).withColumn("count", count)
    # Turns before the span: those of the block behind the system turn, and the end of the last block.
    skipped = F.when(F.col("opens"), 1).otherwise(0)
    own = F.greatest(F.lit(0), F.least(F.lit(HISTORY_TURNS), F.col("first") - 1 - skipped))
    near = F.slice("turns", F.greatest(F.lit(1), F.col("first") - own), own)
    earlier = F.reverse(F.slice(F.reverse(F.concat(F.col("before"), near)), 1, HISTORY_TURNS))
    head = F.when(
        F.col("system").isNull() | (F.col("opens") & (F.col("first") == 1)), F.array().cast(f"array<{_TURN}>")
    ).otherwise(F.array("system"))
    rows = rows.withColumn("earlier", earlier)
    rows = rows.withColumn("repeated", F.concat(head, _history(F.col("earlier"))))
    rows = rows.select(
        "conv_id", "block", "span", F.size("repeated").alias("n_repeated"),
        F.concat("repeated", F.slice("turns", F.col("first"), F.col("count"))).alias("all"),
    )
    return rows.select(
        "conv_id",
        "block",
        "span",
        F.array_join(F.transform("all", _formatted), "").alias("text"),
        "n_repeated",
        _loss(F.col("all"), F.col("n_repeated")).alias("loss_spans"),
        F.aggregate(F.transform("all", _tokens), F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, block, span, new_turns (role, text) and loss_texts of every window, from its text
    and loss spans alone."""
    parts = F.slice(F.split("text", r"<\|im_start\|>"), F.col("n_repeated") + 2, F.lit(1 << 30))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(body).alias("text"))

    def loss(span: Column) -> Column:
        return unescape(F.substring(F.col("text"), span["start"] + 1, span["end"] - span["start"]))

    return windows.select(
        "conv_id", "block", "span", F.transform(parts, turn).alias("new_turns"),
        F.transform("loss_spans", loss).alias("loss_texts"), F.length("text").cast("long").alias("n_chars"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. A digest is over the whole conversation, so its text meets in one
    row here (and only here)."""
    told = F.transform("new_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    pieces = read_back(windows).select(
        "conv_id",
        F.struct("block", "span", F.array_join(told, "").alias("turns"), F.array_join("loss_texts", "").alias("loss")).alias("piece"),
        F.size("new_turns").cast("long").alias("n"),
        "n_chars",
    )
    whole = pieces.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list("piece")).alias("pieces"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    turns = F.array_join(F.transform("pieces", lambda p: p["turns"]), "")
    loss = F.array_join(F.transform("pieces", lambda p: p["loss"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
