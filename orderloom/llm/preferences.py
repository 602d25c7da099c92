"""Preference pairs of conversations as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sqltext import running_sums
from .storage import stored

#: A rendered turn: head, text, end. The marks of the template cannot occur in a text, see ``_render``.
HEAD, TAIL = "concat('<|', {0}.role, '|>\\n')", "'<|end|>\\n'"
TURN = "array<struct<role:string,text:string>>"


def _render(turn: str) -> str:
    return f"concat({HEAD.format(turn)}, replace({turn}.text, '<|', '< |'), {TAIL})"


def conversations_as_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order of turn, role and text.

    Equal rows count once; a null role or text is empty; a null turn comes first; rows without a
    ``conv_id`` belong to no conversation. A conversation is one value, as long as it is.
    """
    kept = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = F.array_sort(F.collect_set(F.struct(F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), "role", "text")))
    rows = kept.groupBy("conv_id").agg(ordered.alias("t"))
    return rows.select("conv_id", F.expr(f"cast(transform(t, x -> named_struct('role', x.role, 'text', x.text)) as {TURN})").alias("turns"))


def pairs_of(conversations: DataFrame) -> DataFrame:
    """``pair_id, rejected_id, kind, chosen, rejected`` made from conversations alone.

    Conversations with one opening turn are put in order of id, and each is compared
    with the next: the one with more assistant text is chosen, the smaller id at a tie
    (``kind`` sibling). The last one, and so every conversation with an opening of its
    own, is compared with itself with the last assistant turn answered by the one
    before it, or by nothing (``kind`` swapped), both ending there; without an
    assistant turn it gives no pair. An opening that many share is ordered in ranges of ids, and the
    last of each range is compared with the first of the next.
    """
    said = "aggregate(turns, 0, (a, t) -> a + if(t.role = 'assistant', length(t.text), 0))"
    rows = conversations.withColumn("opening", F.expr("xxhash64(turns[0].role, turns[0].text)")).withColumn("said", F.expr(said))
    # Only ids, hashes and lengths are put in order; the next conversation joins by its id.
    light = rows.select("conv_id", "opening", "said").repartitionByRange("opening", "conv_id").withColumn("piece", F.spark_partition_id())
    light = stored(light, "conversation-order")
    after = Window.partitionBy("opening", "piece").orderBy("conv_id")
    one = F.struct(F.col("conv_id").alias("next_id"), F.col("said").alias("next_said"))
    within = light.withColumn("next", F.lead(one).over(after))
    # The first of each range follows the last of the one before; an opening has no more ranges than there are tasks.
    firsts = light.groupBy("opening", "piece").agg(F.min(one).alias("first"))
    ahead = firsts.select("opening", "piece", F.lead("first").over(Window.partitionBy("opening").orderBy("piece")).alias("ahead"))
    linked = within.join(ahead.filter("ahead is not null"), ["opening", "piece"], "left").select(
        "conv_id", "said", F.coalesce("next", "ahead").alias("next")
    ).select("conv_id", "said", "next.next_id", "next.next_said")
    own = conversations.select("conv_id", "turns")
    sibling = linked.filter("next_id is not null").join(own, "conv_id").join(
        own.select(F.col("conv_id").alias("next_id"), F.col("turns").alias("next_turns")), "next_id"
    )
    swap = F.col("next_said") > F.col("said")
    siblings = sibling.select(
        F.when(swap, F.col("next_id")).otherwise(F.col("conv_id")).alias("pair_id"),
        F.when(swap, F.col("conv_id")).otherwise(F.col("next_id")).alias("rejected_id"),
        F.lit("sibling").alias("kind"),
        F.when(swap, F.col("next_turns")).otherwise(F.col("turns")).alias("chosen"),
        F.when(swap, F.col("turns")).otherwise(F.col("next_turns")).alias("rejected"),
    )
    alone = linked.filter("next_id is null").select("conv_id").join(own, "conv_id")
    places = "filter(sequence(1, size(turns)), i -> element_at(turns, i).role = 'assistant')"
    alone = alone.withColumn("places", F.expr(places)).filter("size(places) > 0")
    last = "element_at(places, -1)"
    reply = "if(size(places) > 1, element_at(turns, element_at(places, -2)).text, '')"
    worse = f"concat(slice(turns, 1, {last} - 1), array(named_struct('role', 'assistant', 'text', {reply})))"
    swapped = alone.select(
        F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("rejected_id"), F.lit("swapped").alias("kind"),
        F.expr(f"slice(turns, 1, {last})").alias("chosen"), F.expr(f"cast({worse} as {TURN})").alias("rejected"),
    )
    return siblings.unionByName(swapped)


def _completion(df: DataFrame, side: str) -> DataFrame:
    """Add ``side_text`` and ``side_mask``: turns after the prompt, and the stretches of them to be learned."""
    rest = f"slice({side}, n_prompt_turns + 1, size({side}))"
    parts = f"transform({rest}, t -> named_struct('r', t.role, 'x', {_render('t')}, 'h', length({HEAD.format('t')})))"
    df = df.withColumn(f"{side}_p", F.expr(parts)).withColumn(f"{side}_l", F.expr(f"transform({side}_p, p -> length(p.x))"))
    df = df.withColumn(f"{side}_e", F.expr(running_sums(f"{side}_l")))
    zipped = f"filter(arrays_zip({side}_p, {side}_e), z -> z.{side}_p.r = 'assistant')"
    # The head and the last line break of a turn are not learned, its text and end mark are.
    spans = f"transform({zipped}, z -> concat(z.{side}_e - length(z.{side}_p.x) + z.{side}_p.h, ':', z.{side}_e - 1))"
    df = df.withColumn(f"{side}_text", F.expr(f"array_join(transform({side}_p, p -> p.x), '')"))
    return df.withColumn(f"{side}_mask", F.expr(f"array_join({spans}, ',')")).drop(*[f"{side}_{x}" for x in "ple"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Add the training form of ``chosen`` and ``rejected`` (arrays of ``role, text``), in their place.

    ``n_prompt_turns`` counts the longest common prefix of turns that agree in role and
    text, ``prompt`` renders it once. ``chosen_text`` and ``rejected_text`` render the
    turns after it, and ``chosen_mask`` and ``rejected_mask`` are ``first:stop`` of the
    stretches to be learned there, comma-joined: the assistant's texts with their end marks.

    - Where one conversation begins with all of the other, the shorter one's completion is empty.
    - Null conversations are empty, null roles and texts too. A mark of the template in a text is broken up.
    - Other columns stay. An empty table gives no rows.
    """
    df = pairs
    for side in ("chosen", "rejected"):
        filled = f"transform({side}, t -> named_struct('role', coalesce(t.role, ''), 'text', coalesce(t.text, '')))"
        df = df.withColumn(side, F.expr(f"cast(coalesce({filled}, array()) as {TURN})"))
    same = "transform(arrays_zip(chosen, rejected), z -> z.chosen <=> z.rejected)"
    df = df.withColumn("_same", F.expr(same))
    prefix = "cast(if(array_position(_same, false) = 0, size(_same), array_position(_same, false) - 1) as int)"
    df = df.withColumn("n_prompt_turns", F.expr(prefix))
    df = df.withColumn("prompt", F.expr(f"array_join(transform(slice(chosen, 1, n_prompt_turns), t -> {_render('t')}), '')"))
    for side in ("chosen", "rejected"):
        df = _completion(df, side)
    return df.drop("_same", "chosen", "rejected")


def format_conversations(turns: DataFrame) -> DataFrame:
    """The pairs that a table of turns holds, formatted."""
    return format_pairs(pairs_of(conversations_as_turns(turns)))
