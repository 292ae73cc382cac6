"""Chat texts from an event log, built-in functions only.

Events (conv_id, seq, message, kind, role, text) tell how a conversation came to be; ``message`` gives the place of a
message in its conversation.  Kinds: ``start`` begins a message, ``delta`` adds text to it, ``edit`` replaces its whole
text, ``regenerate`` empties it (deltas of the new try follow), ``delete`` removes it.  ``fold`` sorts the events of a
message by ``seq`` and gives its final role and text; ``render`` joins the messages of a conversation with turn marks
and says which characters are trained on; ``parse`` reads turns and trained texts back from the rendered text.

The template of a turn is ``<turn>role\\ntext</turn>\\n``.  Inside roles and texts ``\\`` becomes ``\\b`` and ``<``
becomes ``\\l`` (and a line end in a role ``\\n``), so no text can hold a mark, and unescaping is exact.

Defined results: an event that is there twice counts once; events of one ``seq`` are ordered by kind and text; null
texts are empty, null roles too; events of a null conversation belong to one conversation; a conversation whose
messages are all deleted gives no row; an empty log gives an empty result; other columns are not read.  Deltas meet
per message first, so only final messages meet per conversation; these make up one output text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.exprs import let

OPEN, CLOSE = "<turn>", "</turn>\n"
RESETS = ("start", "edit", "regenerate", "delete")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def turn_events(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", size: int = 400
) -> DataFrame:
    """A log that leads to a finished table of turns, as chats come about: by hash, a message is streamed in deltas of
    ``size`` characters, or streamed after a first try that is thrown away, or edited from a draft; some messages are
    taken back altogether.

    Turns of the same number stay apart: they follow each other by role and text.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        said.alias("text"),
    ).withColumn("message", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))

    def event(kind: str, part: Column | str = "", behind: int = 0) -> Column:
        part = F.lit(part) if isinstance(part, str) else part
        return F.struct(F.lit(kind).alias("kind"), part.alias("part"), F.lit(behind).alias("behind"))

    deltas = F.when(
        F.length("text") > 0,
        F.transform(
            F.sequence(F.lit(0), F.expr(f"cast((length(text) - 1) div {size} as int)")),
            lambda i: event("delta", F.substring(F.col("text"), i * size + 1, F.lit(size))),
        ),
    ).otherwise(F.array().cast("array<struct<kind:string,part:string,behind:int>>"))
    draft = event("delta", F.concat(F.lit("a draft of "), F.left("text", F.lit(40))))
    way = F.pmod(F.xxhash64("conv_id", "message", "text"), F.lit(4))
    own = (
        F.when(way == 0, F.concat(F.array(event("start"), draft, event("regenerate")), deltas))
        .when(way == 1, F.array(event("start"), draft, event("edit", F.col("text"))))
        .otherwise(F.concat(F.array(event("start")), deltas))
    )
    lost = F.when(
        way < 2, F.array(event("start", "", 1), event("delta", "never said", 1), event("delete", "", 1))
    ).otherwise(F.array().cast("array<struct<kind:string,part:string,behind:int>>"))
    return rows.select("conv_id", "message", "role", F.posexplode(F.concat(own, lost)).alias("at", "event")).select(
        "conv_id",
        (F.col("message").cast("bigint") * 2**32 + F.col("at")).cast("bigint").alias("seq"),
        (2 * F.col("message").cast("bigint") + F.col("event.behind")).alias("message"),
        F.col("event.kind").alias("kind"),
        "role",
        F.col("event.part").alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) of every message that was not deleted."""
    told = events.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("message").cast("bigint").alias("message"),
        F.struct(
            F.col("seq").cast("bigint").alias("seq"),
            F.lower(F.col("kind")).alias("kind"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
            F.col("role").cast("string").alias("role"),
        ).alias("e"),
    )
    gathered = told.groupBy("conv_id", "message").agg(F.sort_array(F.collect_set("e")).alias("log"))
    last = F.array_max(
        F.transform(F.col("log"), lambda e, i: F.when(e["kind"].isin(*RESETS), i).otherwise(F.lit(0)))
    )
    live = F.slice(F.col("log"), F.col("last") + 1, F.size("log"))
    roles = F.filter(F.col("log.role"), lambda r: r.isNotNull())
    folded = gathered.select("conv_id", "message", "log", last.alias("last"))
    return folded.filter(~(F.get(F.col("log"), F.col("last"))["kind"].eqNullSafe(F.lit("delete")))).select(
        "conv_id",
        "message",
        F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"),
        F.array_join(
            F.transform(
                live, lambda e: F.when(e["kind"].isin("start", "edit", "delta"), e["text"]).otherwise(F.lit(""))
            ),
            "",
        ).alias("text"),
    )


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, formatted, loss): ``loss`` has start and length, in code points, of each trained text."""
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = messages.select(
        "conv_id",
        "message",
        F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.concat(escape(F.col("text")), F.lit(CLOSE)).alias("tail"),
        (F.col("role") == trained_role).alias("trained"),
    ).withColumn("end", F.sum(F.length("head") + F.length("tail")).over(before))
    turn = F.struct(
        "message",
        F.concat("head", "tail").alias("said"),
        F.when(
            F.col("trained"),
            F.struct(
                (F.col("end") - F.length("tail")).cast("bigint").alias("start"),
                (F.length("tail") - len(CLOSE)).cast("bigint").alias("length"),
            ),
        ).alias("span"),
    )
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return joined.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.col("turns.said"), "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"),
    )


def parse(rendered: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``trained`` (texts under the loss mask), read from ``formatted`` and ``loss``."""
    pieces = F.split("formatted", CLOSE, -1)  # no text holds a mark; the last piece is empty
    turns = F.transform(
        let(pieces, lambda p: F.slice(p, F.lit(1), F.size(p) - 1)),
        lambda t: let(
            F.locate("\n", t),
            lambda cut: F.struct(
                unescape_role(F.substring(t, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)).alias("role"),
                unescape(F.substring(t, cut + 1, F.length(t))).alias("text"),
            ),
        ),
    )
    trained = F.transform(
        "loss",
        lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return rendered.select("*", turns.alias("turns"), trained.alias("trained"))


def format_events(events: DataFrame) -> DataFrame:
    return render(fold(events))
