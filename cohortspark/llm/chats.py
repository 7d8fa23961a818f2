"""Chat logs as events, folded into messages and rendered with a loss mask (operator 2). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortspark.llm.frames import table

OPEN, MID, CLOSE = "<|turn|>", "<|text|>", "<|end|>\n"
EVENTS = "conv_id, seq, turn, role, kind, text"
PART = 256  # characters of a streamed delta made from a stored message


def escape(text: Column) -> Column:
    """A backslash before each backslash and bar, so that no marker can stand inside a text."""
    return F.regexp_replace(text, r"([\\|])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) from a log of events (conv_id, seq, turn, role, kind, text).

    ``delta`` adds its text to the turn's message, ``edit`` replaces it, ``regenerate`` empties it for what follows. An edit or
    a regeneration also takes back every later turn that was written before it. In order of seq; equal seq in order of turn,
    kind and text. Null texts add nothing; a null or other kind counts as delta; null turns come first and null ids are one
    conversation; a turn's role is its first non-null one. A turn with no event left is gone.
    """
    reset = F.col("kind").isin("edit", "regenerate")
    held = events.select(
        "conv_id",
        "turn",
        F.coalesce("seq", F.lit(-1)).cast("long").alias("seq"),
        "role",
        F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id", "turn").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = held.withColumns(
        {
            "cut": F.max(F.when(reset, F.col("seq"))).over(before),
            "role": F.coalesce(F.first("role", ignorenulls=True).over(whole), F.lit("")),
        }
    )
    held = held.where("cut IS NULL OR seq >= cut")
    said = F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.col("text"))
    parts = F.array_sort(F.collect_list(F.struct("seq", "kind", said.alias("text"))))
    text = F.concat_ws("", F.transform(parts, lambda p: p["text"]))
    return held.groupBy("conv_id", "turn").agg(F.first("role").alias("role"), text.alias("text"))


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, segments, formatted): messages in order of turn, then role and text, as one text per conversation.

    ``segments`` is the text in pieces with a loss flag: 1 for the contents of ``trained`` messages. Their texts joined are
    ``formatted``. An empty frame gives an empty result.
    """
    message = F.struct("turn", "role", "text")
    grouped = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("m"))

    def pieces(m: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape(m["role"]), F.lit(MID))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(m["text"]).alias("text"), (m["role"] == trained).alias("loss")),
            F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
        )

    segments = F.flatten(F.transform("m", pieces))
    out = grouped.select("conv_id", segments.alias("segments"))
    return out.withColumn("formatted", F.concat_ws("", F.transform("segments", lambda s: s["text"])))


def parse(formatted: Column) -> Column:
    """The messages of a rendered text: array of (role, text)."""
    turns = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda t: t.startswith(OPEN))

    def message(turn: Column) -> Column:
        body = F.substring(turn, len(OPEN) + 1, 2**31 - 1)
        return F.struct(
            unescape(F.substring_index(body, MID, 1)).alias("role"),
            unescape(F.substring(body, F.instr(body, MID) + len(MID), F.length(body))).alias("text"),
        )

    return F.transform(turns, message)


def digest(rendered: DataFrame) -> DataFrame:
    """What is read back from rendered conversations."""
    lost = F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])))
    read = rendered.select("conv_id", parse(F.col("formatted")).alias("turns"), lost.alias("lost"), "formatted")
    line = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(line, 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def as_events(conversations: DataFrame, part: int = PART) -> DataFrame:
    """Stored messages as the log of their streaming: deltas of ``part`` characters. Rows of equal turn are messages of their
    own, in order of role and text; null texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    stored = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text.alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    count = F.greatest(F.lit(1), F.ceil(F.length("text") / part)).cast("int")
    at = F.explode(F.sequence(F.lit(0), count - 1)).alias("at")
    rows = stored.withColumn("turn", F.row_number().over(order).cast("long")).select("*", at)
    return rows.select(
        "conv_id",
        (F.col("turn") * 2**32 + F.col("at")).alias("seq"),
        "turn",
        "role",
        F.lit("delta").alias("kind"),
        F.substring("text", F.col("at") * part + 1, F.lit(part)).alias("text"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT -1L AS conv_id, turn, role, '{control}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return digest(render(fold_events(as_events(stored.union(extra)))))


QUERIES = {"op2_chat": op2_chat}
ORACLES = {
    "op2_chat": r"""
WITH m AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, length(text) + length(regexp_replace(text, '[^\\|]', '', 'g'))
            + length(role) + length(regexp_replace(role, '[^\\|]', '', 'g')) + 24 AS chars
    FROM m
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
}
