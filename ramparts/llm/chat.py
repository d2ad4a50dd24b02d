"""Conversations from event logs, rendered with a loss mask, and read back; SQL functions only.

An event is (conv_id, message, seq, kind, role, text). ``message`` orders the messages of a conversation, ``seq`` the
events of a message. A ``delta`` adds its text, an ``edit`` replaces what the message says, a ``regenerate`` empties it.
The role is that of the message's last event that has one.

A message is rendered as START role newline text END. Inside roles and texts a backslash is doubled and ``<|`` becomes
``<\\|``; in a role a newline becomes ``\\n``. So no text can hold a mark, and every text comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

START, END, TRAINED = "<|turn|>", "<|end|>", "assistant"
SPLIT_END = r"<\|end\|>"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """Between doubled backslashes, a backslash stands only before the bar or, in a role, before the n."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|"))), "\\")


def unescaped_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)
    plain = lambda p: F.replace(F.replace(p, F.lit("<\\|"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(parts, plain), "\\")


def folded(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): each message as its last edit or regeneration and the deltas since leave it.

    Grouped by message, so a conversation with very many messages spreads over tasks. Events of equal seq are taken
    in the order of kind and text; repeated events count again. Null texts are empty, null roles empty if no event has one.
    """
    event = F.struct(
        "seq",
        F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("role"),
    )
    logs = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    resets = F.filter("log", lambda e: e["kind"] != "delta")
    last = F.array_max(F.transform(resets, lambda e: F.struct(e["seq"], e["kind"], e["text"])))

    def counts(e: Column) -> Column:
        return last.isNull() | (F.struct(e["seq"], e["kind"], e["text"]) >= last)

    said = F.transform(
        F.filter("log", counts), lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"])
    )
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    role = F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit(""))
    return logs.select("conv_id", "message", role.alias("role"), F.array_join(said, "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) from messages (conv_id, message, role, text).

    ``mask`` lists runs of (length in code points, loss): for each message its head, its text and its end. Only texts
    of assistants are trained on. A conversation is one string, put together where its rendered messages meet; each of
    them is rendered before. Messages of equal place are ordered by role and text.
    """
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    piece = messages.select(
        "conv_id", F.struct("message", "role", "text", head.alias("head"), body.alias("body")).alias("piece")
    )
    whole = piece.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))

    def run(length: Column, loss: Column) -> Column:
        return F.struct(length.cast("long").alias("length"), loss.alias("loss"))

    runs = F.transform(
        "pieces",
        lambda p: F.array(
            run(F.length(p["head"]), F.lit(False)),
            run(F.length(p["body"]), p["role"] == TRAINED),
            run(F.lit(len(END)), F.lit(False)),
        ),
    )
    strings = F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END)))
    return whole.select("conv_id", F.array_join(strings, "").alias("formatted"), F.flatten(runs).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted) from what ``rendered`` gives: turns are (role, text), loss_text is all
    text under the mask. Fails if the mask does not fit the string."""
    pieces = F.split("formatted", SPLIT_END, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def cut(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        return F.struct(head.alias("head"), F.substr(piece, F.length(head) + 2).alias("body"))

    parsed = formatted.select("conv_id", "formatted", "mask", F.transform(pieces, cut).alias("pieces"))
    segments = F.flatten(
        F.transform("pieces", lambda p: F.array(F.concat(p["head"], F.lit("\n")), p["body"], F.lit(END)))
    )
    cut_up = parsed.select("conv_id", "formatted", "pieces", "mask", segments.alias("segments"))
    lengths = F.transform("segments", lambda s: F.length(s).cast("long"))
    fits = lengths == F.transform("mask", lambda r: r["length"])
    masked = F.filter(F.arrays_zip("segments", "mask"), lambda z: z["mask"]["loss"])
    text = F.array_join(F.transform(masked, lambda z: unescaped(z["segments"])), "")
    turns = F.transform(
        "pieces",
        lambda p: F.struct(
            unescaped_role(F.substr(p["head"], F.lit(len(START) + 1))).alias("role"), unescaped(p["body"]).alias("text")
        ),
    )
    loss = F.when(fits, text).otherwise(F.raise_error(F.lit("the mask does not fit the text")).cast("string"))
    return cut_up.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), "formatted")


def table_events(conversations: DataFrame) -> DataFrame:
    """Each row of (conv_id, turn, role, text) as the one delta of a message of its own: rows that share a turn are
    ordered by role and text, so their message is the turn with these."""
    message = F.struct(F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"))
    copies = conversations.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    each = copies.withColumn("seq", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return each.select(
        "conv_id",
        F.struct(message.alias("row"), "seq").alias("message"),
        "seq",
        F.lit("delta").alias("kind"),
        "role",
        "text",
    )


def conversation_digests(conversations: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """Digests of what is read back from the formatted conversations, a row for each conv_id (null is one too).

    ``probes`` are more rows of the same columns. Null roles and texts are empty. No rows give no rows.
    """
    wanted = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(*wanted)
    if probes is not None:
        rows = rows.unionByName(probes.select(*wanted))
    back = read_back(rendered(folded(table_events(rows))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def probe_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1: both sides say control strings."""
    said = "</s>[INST] ok [/INST]"
    one = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return one
