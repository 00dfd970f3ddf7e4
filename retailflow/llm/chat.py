"""Chat formatting by rotating the perspective of multi-party dialogues.

Every participant of a dialogue gets a rendering in which they are the assistant and all
others are users with their names; a mask marks the assistant's words, the ones to
train on. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import materialise

START, END = "<|start|>", "<|end|>"
#: Messages of one rendering. Longer dialogues give several, so that a row stays bounded.
PART_MESSAGES = 1024
#: Characters of a text by which tied messages are dealt out; all of it orders them.
DEALT_CHARS = 256


def rotate_dialogues(
    turns: DataFrame, system_role: str = "system", part_messages: int = PART_MESSAGES
) -> DataFrame:
    """Every conversation, whole, from the view of each of its participants.

    ``turns`` has ``conv_id, turn, role, text``; other columns do not matter. Columns:
    ``conv_id``, ``part`` (number of the slice), ``speaker``, ``rendered``,
    ``mask`` (character spans ``start-end`` of the speaker's words with their end mark,
    comma-separated), ``n_messages``, ``n_masked_chars``. Whoever speaks anywhere in a conversation
    gets all of it.

    - Messages stand in order of turn, then role, then text, nulls first. Repeated rows count once.
    - The system role speaks in every rendering and is no participant; neither is a null or
      blank role, which is rendered as a user named ``unknown``.
    - A null text is empty, a row without ``conv_id`` belongs to no conversation. Control marks
      inside texts and names are broken up. An empty table gives an empty result.
    - Messages are numbered in their order from 0; ``part`` is the number by ``part_messages``,
      rounded down, whatever the turns are. So a row holds ``part_messages`` messages at most.
    - Every participant gets every part. In a part in which they are silent ``mask`` is empty.
    - Parts are slices: a participant's parts, put together in order, are the whole rendering, with
      each message once. A system message stands in its place and is not repeated in later parts.
    - Only a conversation without any participant gives no row.

    A conversation of at most ``part_messages`` rows is one group. Longer ones are ordered by range
    over all tasks and numbered from counts per task, so a dialogue of a third of all rows, with
    null or tied turns too, becomes many tasks and groups. Messages that share turn, role and
    their first ``DEALT_CHARS`` characters are sorted in one task, which spills. The
    result holds participants times messages, which is what a view for each of them means.
    """
    said = _messages(turns)
    sizes = said.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    long_ids = materialise(sizes.filter(F.col("n") > part_messages).select("conv_id"), "long-dialogues")
    some_long = not long_ids.isEmpty()

    short = said.join(long_ids, "conv_id", "left_anti") if some_long else said
    whole = short.distinct().groupBy("conv_id").agg(_in_order().alias("messages"))
    views = _views(whole.withColumn("part", F.lit(0).cast("long")), system_role)
    if some_long:
        numbered = _numbered(said.join(long_ids, "conv_id", "left_semi").distinct())
        numbered = numbered.withColumn("part", F.floor(F.col("number") / F.lit(part_messages)).cast("long"))
        parts = numbered.groupBy("conv_id", "part").agg(_in_order().alias("messages"))
        speakers = numbered.filter(F.col("role").isNotNull() & (F.col("role") != system_role))
        speakers = speakers.select("conv_id", F.col("role").alias("speaker")).distinct()
        # Narrow rows meet first; the texts of a dialogue are dealt by part.
        wanted = numbered.select("conv_id", "part").distinct().join(speakers, "conv_id")
        views = views.unionByName(parts.join(wanted, ["conv_id", "part"]).select(*views.columns))
    return _render(views, system_role)


def _messages(turns: DataFrame) -> DataFrame:
    role = F.trim("role")
    return turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.col("turn").alias("turn"),
        F.when(role != "", role).alias("role"),
        _plain(F.coalesce("text", F.lit(""))).alias("text"),
    )


def _in_order() -> Column:
    return F.array_sort(F.collect_list(F.struct("turn", "role", "text")))


def _numbered(messages: DataFrame) -> DataFrame:
    """Distinct messages with their ``number`` in their conversation, from 0."""
    dealt = messages.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(DEALT_CHARS)))
    placed = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    # Stored, as another run could cut the ranges elsewhere.
    placed = materialise(placed.withColumn("at", F.monotonically_increasing_id()), "dialogues")
    placed = placed.withColumn("range", F.shiftright("at", 33))
    ranges = placed.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    shifts = ranges.select("conv_id", "range", (before - F.col("first")).alias("shift"))
    return placed.join(shifts, ["conv_id", "range"]).withColumn("number", F.col("at") + F.col("shift"))


def _views(parts: DataFrame, system_role: str) -> DataFrame:
    """Each part once for each participant who speaks in it."""
    speakers = F.array_distinct(F.transform("messages", lambda m: m["role"]))
    speakers = F.filter(speakers, lambda r: r.isNotNull() & (r != system_role))
    return parts.select("conv_id", "part", "messages", F.explode(speakers).alias("speaker"))


def _render(views: DataFrame, system_role: str) -> DataFrame:
    own = lambda m: m["role"].eqNullSafe(F.col("speaker"))
    pieces = F.transform(
        "messages",
        lambda m: F.struct(
            F.when(own(m), F.lit(f"{START}assistant\n"))
            .when(m["role"] == system_role, F.lit(f"{START}system\n"))
            .otherwise(F.concat(F.lit(f"{START}user name="), _name(m["role"]), F.lit("\n")))
            .alias("head"),
            F.concat(m["text"], F.lit(END)).alias("said"),
            own(m).alias("own"),
        ),
    )
    views = views.select("conv_id", "part", "speaker", pieces.alias("pieces"))
    walked = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).cast("long").alias("masked")),
        _walk,
    )
    views = views.select("conv_id", "part", "speaker", "pieces", walked.alias("w"))
    return views.select(
        "conv_id",
        "part",
        "speaker",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["said"], F.lit("\n"))), "").alias("rendered"),
        F.array_join("w.spans", ",").alias("mask"),
        F.size("pieces").cast("long").alias("n_messages"),
        F.col("w.masked").alias("n_masked_chars"),
    )


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _name(role: Column) -> Column:
    return F.replace(_plain(F.coalesce(role, F.lit("unknown"))), F.lit("\n"), F.lit(" "))


def _walk(state: Column, piece: Column) -> Column:
    """Move on by one message, and note its span if it is the speaker's."""
    start = state["at"] + F.length(piece["head"])
    stop = start + F.length(piece["said"])
    span = F.array(F.concat(start.cast("string"), F.lit("-"), stop.cast("string")))
    return F.struct(
        (stop + 1).alias("at"),
        F.when(piece["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        (state["masked"] + F.when(piece["own"], stop - start).otherwise(F.lit(0)).cast("long")).alias("masked"),
    )
