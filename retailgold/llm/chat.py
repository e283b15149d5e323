"""Chat formatting from an event log: streamed deltas, edits and regenerations fold into messages, which are rendered as turns.

A log has a row per event: ``conv_id``, ``seq`` (any type that sorts), ``message`` (a conversation's own name for a message),
``kind``, ``role`` and ``text``.

* ``open`` begins a message and names its role; a later role that is not null replaces it.
* ``delta`` appends its text to the message.
* ``edit`` replaces all text up to there by its own.
* ``regenerate`` drops all text up to there; what is streamed after it is the new message.

Events are folded in the order of ``seq``, whatever order they come in; an event that is delivered again (all fields equal)
counts once; other kinds are passed over.  A message stands where its first event stands.  Messages are grouped by conversation
and message, so a long conversation is folded in parallel; only its finished string is one row.

Turns are marked by control strings.  Inside a text each of them gets a backslash after its first character, and one that has
backslashes there already gets one more, so every text comes back exactly and texts without such strings are unchanged.

Odd input: null text and role count as empty, an empty log gives no rows, a null conversation is one of its own.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[SAYS]", "[/ROLE]")
_TAIL = r"(/?s>|/?INST\]|/?ROLE\]|SAYS\])"
_TURN = r"(?s)\[INST\] .*? \[/INST\]|<s> .*? </s>|\[ROLE\] .*? \[/ROLE\]"
DELTA_CHARS = 200


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2$3")


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, message, opened, role, text): one row per message; ``opened`` is the seq of its first event."""
    events = log.groupBy("conv_id", "message").agg(F.array_sort(F.collect_set(F.struct("seq", "kind", "role", "text"))).alias("events"))
    # the number of the last event before which nothing of the text is left
    restart = F.array_max(F.transform("events", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i)))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return (
        events.withColumn("restart", F.coalesce(restart, F.lit(0)))
        .withColumn("said", F.filter("events", lambda e, i: (i >= F.col("restart")) & e["kind"].isin("delta", "edit")))
        .select(
            "conv_id", "message", F.get("events", F.lit(0))["seq"].alias("opened"),
            F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
            F.array_join(F.transform("said", lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """Messages with ``turn``, their rendered text, and the code points of it that are trained on: ``start`` (from 0), ``length``.

    An assistant's text is trained on, its markers and all other turns are not (length 0).
    """
    other = F.concat(F.lit("[ROLE] "), escape(F.col("role")), F.lit(" [SAYS] "))
    begin = F.when(F.col("role") == "user", F.lit("[INST] ")).when(F.col("role") == "assistant", F.lit("<s> ")).otherwise(other)
    end = F.when(F.col("role") == "user", F.lit(" [/INST]")).when(F.col("role") == "assistant", F.lit(" </s>")).otherwise(F.lit(" [/ROLE]"))
    said = messages.withColumn("_said", escape(F.col("text")))
    trained = F.when(F.col("role") == "assistant", F.length("_said")).otherwise(F.lit(0))
    return said.select("*", F.concat(begin, "_said", end).alias("turn"), F.length(begin).alias("start"), trained.alias("length")).drop("_said")


def format_conversations(log: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask): one string per conversation.

    ``mask`` has for each turn where its trained text starts within the turn and how many code points it has (0: none).  Places
    are counted from the turn, so that no sum runs through a whole conversation.
    """
    turn = F.struct("opened", "message", "turn", "start", "length")
    each = render(fold(log)).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return each.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("mask"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Adds ``pieces``, the turns cut out of the string, and ``turns``, their roles and texts as they were."""
    def parsed(p: Column) -> Column:
        inner = F.regexp_replace(p, r"(?s)^\[ROLE\] (.*) \[/ROLE\]$", "$1")
        user = F.struct(F.lit("user").alias("role"), unescape(F.substring(p, F.lit(8), F.length(p) - 15)).alias("text"))
        assistant = F.struct(F.lit("assistant").alias("role"), unescape(F.substring(p, F.lit(5), F.length(p) - 9)).alias("text"))
        other = F.struct(
            unescape(F.regexp_replace(inner, r"(?s) \[SAYS\] .*$", "")).alias("role"),
            unescape(F.regexp_replace(inner, r"(?s)^.*? \[SAYS\] ", "")).alias("text"),
        )
        return F.when(p.startswith("[INST]"), user).when(p.startswith("<s>"), assistant).otherwise(other)

    cut = formatted.withColumn("pieces", F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0)))
    return cut.withColumn("turns", F.transform("pieces", parsed))


def loss_text() -> Column:
    """What the mask covers of ``pieces``, unescaped and put together."""
    under = F.zip_with("pieces", "mask", lambda p, m: unescape(F.substring(p, m["start"] + 1, m["length"])))
    return F.array_join(under, "")


def log_of(conversations: DataFrame) -> DataFrame:
    """The log that leads to a table (conv_id, turn, role, text), with drafts that were edited or regenerated on the way.

    Turns follow each other by number, null first, then by role and MD5 of the text; repeated rows are messages of their own.  Rows
    are numbered where they are read, so the table should be one whose scan repeats itself, such as files.  A text comes in
    deltas of 200 code points.  One row in four of the assistant's, by CRC-32, is begun, dropped and generated anew, and
    one in four of the others' is first said differently and then edited.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("message"),
        (F.crc32(F.concat_ws(":", "conv_id", "turn")) % 4 == 0).alias("redone"),
    )

    def event(kind: str, said: Column, who: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (F.lit(None).cast("string") if who is None else who).alias("role"), said.alias("text"))

    none = F.lit(None).cast("string")
    deltas = F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0)), lambda t: event("delta", t))
    draft = event("delta", F.reverse(F.substring("text", 1, 60)))
    anew = F.concat(F.array(draft, event("regenerate", none)), deltas)
    edited = F.array(draft, event("edit", F.col("text")))
    streamed = F.when(F.col("redone") & (F.col("role") == "assistant"), anew).when(F.col("redone"), edited).otherwise(deltas)
    placed = F.transform(F.concat(F.array(event("open", none, F.col("role"))), streamed), lambda e, i: F.struct(
        F.struct(F.col("turn"), F.col("role").alias("role"), F.col("digest"), F.col("message"), i.alias("step")).alias("seq"), e["kind"].alias("kind"),
        e["role"].alias("role"), e["text"].alias("text"),
    ))
    return rows.withColumn("digest", F.md5("text")).select("conv_id", "message", F.inline(placed))
