"""Chat formatting in budgeted windows, in DataFrame functions only.

Turns are numbered and their tokens summed up per conversation by a prefix sum in
two levels (within blocks of turns, then over the blocks' totals), so a very long
conversation is spread over tasks. The prefix sums choose windows of whole
turns: a turn belongs to the window in whose stretch of the sum it starts. The
stretch is the budget less what the system turn, the repeated history and the
longest turn can take. A turn of more than half of what the history leaves of the
budget stands alone in a window of its own and counts in no stretch, so other turns
are packed as ever; only such a turn, or a system turn as long, can make a window
exceed the budget. Every window but the first repeats the conversation's leading
system turn and up to `history` turns before it, as far as `history_tokens`
allow. What is repeated is context: it has no loss. Each assistant text is under
the loss mask once.

A turn is <|im_start|>role, a line feed, the text, <|im_end|> and a line feed.
In roles and texts each <| gets one more |, which is taken away again on reading;
line feeds and backslashes in roles are written \\n and \\\\.

Cases: null texts and roles are empty; turns are ordered by number, nulls first,
then role and text, and repeated rows are turns of their own; a null conversation
id is one conversation; empty and very long texts are kept whole; no rows give no
windows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.llm.shared import stored

BUDGET, HISTORY, HISTORY_TOKENS, CHARS_PER_TOKEN = 2048, 2, 256, 4
START, END = "<|im_start|>", "<|im_end|>\n"
#: Turn numbers of a block of the prefix sum; windows are numbered on by this much behind and before a turn that stands alone.
BLOCK, ALONE = 256, 1 << 32


def escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    # A pair of backslashes is one; outside of pairs, \\n is a line feed.
    parts = F.split(unescaped(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def placed(conversations: DataFrame, budget: int, history_tokens: int, chars_per_token: int) -> DataFrame:
    """Each turn with cid (the conversation, never null), idx, before (tokens before it), window, and
    whether its conversation has more than one window. Written once, as several steps read it.

    Texts move once, to number the turns of each block; all else about blocks and
    conversations is narrow.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    out = F.concat(F.lit(START), _role_out(role), F.lit("\n"), escaped(text), F.lit(END))
    cid = F.when(F.col("conv_id").isNull(), "none").otherwise(F.concat(F.lit("id "), F.col("conv_id").cast("string")))
    turn = F.col("turn").cast("long")
    turns = conversations.select("conv_id", cid.alias("cid"), F.coalesce(F.floor(turn / BLOCK), F.lit(-(2**62))).alias("block"), turn.alias("turn"), role.alias("role"), text.alias("text"), F.ceil(F.length(out) / chars_per_token).alias("tokens"))
    earlier = Window.partitionBy("cid", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    large = F.col("tokens") > (budget - history_tokens) / 2
    small = F.when(large, 0).otherwise(F.col("tokens"))
    sums = {"n": F.count(F.lit(1)).over(earlier), "t": F.coalesce(F.sum("tokens").over(earlier), F.lit(0)), "s": F.coalesce(F.sum(small).over(earlier), F.lit(0)), "l": F.count_if(large).over(earlier)}
    turns = turns.withColumns(sums)
    blocks = turns.groupBy("cid", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.sum(small).alias("s"), F.count_if(large).alias("l"), F.max(small).alias("longest"), F.max(F.when((F.col("n") == 0) & (F.col("role") == "system"), F.col("tokens"))).alias("system"))
    every = Window.partitionBy("cid")
    ahead = every.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = every.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = [F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}0") for c in ("n", "t", "s", "l")]
    blocks = blocks.select("cid", "block", *before, F.max("longest").over(every).alias("longest"), F.sum("s").over(every).alias("total"), F.sum("l").over(every).alias("alone"), F.first("system").over(whole).alias("system"))
    room = F.greatest(F.lit(1), F.lit(budget - history_tokens) - F.coalesce("system", F.lit(0)) - F.col("longest"))
    joined = turns.join(blocks, ["cid", "block"])
    stretch = F.when(large, 0).otherwise(F.floor((F.col("s") + F.col("s0")) / room))
    window = ((F.col("l") + F.col("l0")) * 2 + large.cast("long")) * F.lit(ALONE).cast("long") + stretch
    return stored(joined.select("conv_id", "cid", (F.col("n") + F.col("n0")).alias("idx"), (F.col("t") + F.col("t0")).alias("before"), "role", "text", "tokens", "system", window.alias("window"), ((F.col("total") > room) | (F.col("alone") > 0)).alias("several")), "turns")


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_tokens: int = HISTORY_TOKENS, chars_per_token: int = CHARS_PER_TOKEN) -> DataFrame:
    """(conv_id, window, n_context, n_tokens, text, loss) from (conv_id, turn, role, text).

    n_context turns at the start are repeated ones; loss holds the spans
    (first, length), in code points of text from 0, of the assistant texts that
    are learned here. A turn's tokens are its formatted length over
    chars_per_token, rounded up.
    """
    turns = placed(conversations, budget, history_tokens, chars_per_token)
    columns = ["conv_id", "cid", "window", "idx", "repeated", "role", "text", "tokens"]
    own = turns.withColumn("repeated", F.lit(False)).select(*columns)
    long = turns.where("several")
    first = long.groupBy("cid", "window").agg(F.min("idx").alias("idx"), F.min("before").alias("before"), F.max("system").alias("system")).where("idx > 0")
    head = long.where((F.col("idx") == 0) & F.col("system").isNotNull()).select("conv_id", "cid", F.lit(-1).cast("long").alias("idx"), F.lit(True).alias("repeated"), "role", "text", "tokens")
    heads = head.join(first.select("cid", "window"), "cid").select(*columns)
    oldest = F.greatest(F.when(F.col("system").isNotNull(), 1).otherwise(0).cast("long"), F.col("idx") - history)
    asked = first.select("cid", F.col("window").alias("_window"), F.col("before").alias("_before"), F.explode(F.when(oldest < F.col("idx"), F.sequence(oldest, F.col("idx") - 1))).alias("idx"))
    past = long.join(asked, ["cid", "idx"]).where(F.col("_before") - F.col("before") <= history_tokens)
    past = past.withColumn("window", F.col("_window")).withColumn("repeated", F.lit(True)).select(*columns)
    rows = own.unionByName(heads).unionByName(past)
    # A window's turns are bounded by the budget.
    grouped = rows.groupBy("cid", "conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("idx", "repeated", "role", "text", "tokens"))).alias("turns"))
    parts = F.transform("turns", lambda t: F.struct(F.concat(F.lit(START), _role_out(t.role), F.lit("\n")).alias("head"), escaped(t.text).alias("body"), ((t.role == "assistant") & ~t.repeated).alias("learned")))
    grouped = grouped.withColumn("parts", parts)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,length:int>>").alias("spans"))

    def add(done: Column, part: Column) -> Column:
        first_char = done.at + F.length(part.head)
        span = F.struct(first_char.alias("first"), F.length(part.body).alias("length"))
        return F.struct((first_char + F.length(part.body) + len(END)).alias("at"), F.when(part.learned, F.array_append(done.spans, span)).otherwise(done.spans).alias("spans"))

    return grouped.select(
        "conv_id",
        "window",
        F.size(F.filter("turns", lambda t: t.repeated)).alias("n_context"),
        F.aggregate(F.col("turns.tokens"), F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
        F.array_join(F.transform("parts", lambda p: F.concat(p.head, p.body, F.lit(END))), "").alias("text"),
        F.aggregate("parts", start, add).spans.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss_text, n_chars): a window's own turns (role, text), unescaped,
    and the texts under its loss mask.
    """
    pieces = F.split("text", r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    mine = F.slice(pieces, F.col("n_context") + 1, F.greatest(F.size(pieces) - F.col("n_context"), F.lit(0)))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, "\n")
        return F.struct(_role_in(F.substr(piece, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"), unescaped(F.substr(piece, at + 1)).alias("text"))

    loss = F.transform("loss", lambda s: unescaped(F.substr(F.col("text"), s.first + 1, s.length)))
    return formatted.select("conv_id", "window", F.transform(mine, turn).alias("turns"), loss.alias("loss_text"), F.length("text").cast("long").alias("n_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted windows say about each conversation, read back from them."""
    windows_of = read_back(formatted).select(
        "conv_id",
        "window",
        F.size("turns").cast("long").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("all"),
        F.array_join("loss_text", "").alias("loss"),
        "n_chars",
    )
    # A digest of a whole conversation needs its whole text in one value.
    whole = windows_of.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "all", "loss"))).alias("w"), F.sum("n_chars").alias("formatted_chars"))
    text = F.array_join(F.col("w.all"), "")
    loss = F.array_join(F.col("w.loss"), "")
    return whole.select("conv_id", "n_turns", F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
