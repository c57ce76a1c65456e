"""Reply trees to chat texts: the best branches, each formatted as one conversation.

Messages answer other messages. A branch is a path from a root (a message without
parent, or whose parent is not there) to a leaf; its score is the sum of its messages'
scores. Spark SQL functions only.

* Paths are enumerated by iterative self-joins in which reach doubles: after round k a
  message knows its ancestor 2^k steps up and the score up to there, so a tree of depth
  d takes log2(d) + 1 joins of ids; every round is written. Leaves then know their
  path's score and depth and are ranked in their tree.
* The messages of chosen leaves are found by going the same jumps back, from the longest
  to the shortest: each join doubles the known part of all chosen paths.
* Texts are shuffled once, by tree. For the best branch alone, messages beside it are
  taken out before that, by a broadcast only if their number is checked to be small.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. In roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|`` (in roles a line feed gets a backslash
too), so control strings stand at turn edges only and reading back is exact. The loss
mask gives, per assistant turn, the places of its text: (turn, start, end), in code
points from the turn's first character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hypnolith.llm.tables import computed, rows_with_ids, stored

# The template's control strings and the role that is learned.
START, END, FEED = "<|im_start|>", "<|im_end|>", "\n"
LEARNED = "assistant"

#: Turns of a conversation that one window of :func:`replies_of_turns` orders.
TURN_BLOCK = 4096

_FIRST_LINE = r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)$"


def _id(name: str) -> Column:
    """An id of any kind as text; a missing one is '' and no other is."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _nodes(replies: DataFrame) -> DataFrame:
    """One row per message: key, node, parent (text; '' for none), score."""
    rows = replies.select(
        _id("tree_id").alias("key"), _id("message_id").alias("node"), _id("parent_id").alias("parent"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    return rows.groupBy("key", "node").agg(F.max("parent").alias("parent"), F.max("score").alias("score"))


def _jumps(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(key, node, score, depth of every message with a root; jumps of 1, 2, 4 .. steps up).

    Messages whose parents lead in a circle never reach a root: rounds end when no
    further message does, and such messages have no path.
    """
    parents = nodes.filter("node <> ''").select("key", F.col("node").alias("parent"), F.lit(True).alias("there"))
    reach = stored(
        nodes.join(parents, ["key", "parent"], "left").select(
            "key", "node", F.when(F.col("there"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("depth")
        ),
        "reply-reach",
    )
    jumps, before = [], None
    while True:
        open_ = reach.filter("up IS NOT NULL").count()
        if not open_ or open_ == before:
            break
        before = open_
        jumps.append(reach.filter("up IS NOT NULL").select("key", "node", "up"))
        above = reach.select(
            "key", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("score").alias("_score"), F.col("depth").alias("_depth")
        )
        moved = reach.filter("up IS NOT NULL").join(above, ["key", "up"]).select(
            "key", "node", F.col("_up").alias("up"), (F.col("score") + F.col("_score")).alias("score"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
        )
        reach = stored(reach.filter("up IS NULL").unionByName(moved), "reply-reach")
    return reach.filter("up IS NULL").drop("up"), jumps


def branches(replies: DataFrame, most: int = 1) -> DataFrame:
    """key, branch, node, place: messages of the ``most`` best branches of every tree.

    replies: tree_id, message_id, parent_id and, if branches are to be ranked, score.
    Branches are numbered from 1 by descending score; of equal ones the longer, then the
    one with the lesser leaf id (as text) comes first. ``place`` counts from the root.
    Missing scores are 0. Rows that repeat a message of their tree are one message with
    its greatest score. Rows without tree_id are one tree; a tree's rows without
    message_id are one message that nothing answers.
    """
    if most < 1:
        raise ValueError("at least one branch is chosen")
    replies = replies if "score" in replies.columns else replies.withColumn("score", F.lit(0.0))
    nodes = stored(_nodes(replies), "reply-nodes")
    paths, jumps = _jumps(nodes)
    answered = nodes.filter("parent <> ''").select("key", F.col("parent").alias("node")).distinct()
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.desc("depth"), "node")
    leaves = (
        paths.join(answered, ["key", "node"], "left_anti")
        .withColumn("branch", F.row_number().over(order))
        .filter(F.col("branch") <= most)
    )
    known = leaves.select("key", "branch", "node", (F.col("depth") - 1).alias("place"))
    for k in reversed(range(len(jumps))):
        here, there = F.struct("node", "place"), F.struct(F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there))
        known = known.join(jumps[k], ["key", "node"], "left").select("key", "branch", F.inline(both))
    return known


def format_branches(messages: DataFrame, replies: DataFrame | None = None, most: int = 1) -> DataFrame:
    """tree_id, branch, formatted, loss_mask: one conversation per chosen branch.

    messages: tree_id, message_id, role, text; replies: see :func:`branches`, ``messages``
    itself unless given. A message of several rows says each of them, by role and text.
    Messages that ``replies`` does not list are on no branch. Null roles and texts are
    empty. Other columns are ignored; an empty table has no conversations.
    """
    counted = messages.select(_id("tree_id").alias("key"), _id("message_id").alias("node")).groupBy("key", "node").agg(
        F.count("*").alias("rows")
    )
    chosen = branches(messages if replies is None else replies, most).join(counted, ["key", "node"])
    chosen = stored(chosen.select("key", "branch", "node", "place", "rows"), "reply-branches")
    said = messages.select(
        F.col("tree_id"), _id("tree_id").alias("key"), _id("message_id").alias("node"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    if most == 1:
        beside = counted.select("key", "node").join(chosen.select("key", "node"), ["key", "node"], "left_anti")
        said = rows_with_ids(said, stored(beside, "reply-beside"), "left_anti").withColumn("branch", F.lit(1))
    else:
        said = said.join(chosen.select("key", "node", "branch"), ["key", "node"])
    turns = said.groupBy("key", "branch").agg(
        F.first("tree_id").alias("tree_id"), F.sort_array(F.collect_list(F.struct("node", "role", "text"))).alias("said")
    )
    places = chosen.groupBy("key", "branch").agg(F.sort_array(F.collect_list(F.struct("node", "place", "rows"))).alias("path"))
    # Both lists are by message, so the k-th thing said has the k-th place.
    spread = F.flatten(F.transform("path", lambda p: F.array_repeat(p.place, p.rows.cast("int"))))
    placed = F.zip_with("said", spread, lambda s, p: F.struct(p.alias("place"), s.role.alias("role"), s.text.alias("text")))
    ordered = computed(
        turns.join(places, ["key", "branch"]), [F.col("tree_id"), F.col("branch")], turns=F.sort_array(placed)
    )
    head = lambda t: F.concat(F.lit(START), F.replace(escaped(t.role), F.lit(FEED), F.lit("\\" + FEED)), F.lit(FEED))
    segments = F.transform("turns", lambda t: F.concat(head(t), escaped(t.text), F.lit(END + FEED)))
    spans = F.transform(
        "turns",
        lambda t, k: F.struct(
            k.alias("turn"), F.length(head(t)).alias("start"), (F.length(head(t)) + F.length(escaped(t.text))).alias("end")
        ),
    )
    learned = F.filter(spans, lambda s: F.col("turns")[s.turn].role == LEARNED)
    return ordered.select("tree_id", "branch", F.array_join(segments, "").alias("formatted"), learned.alias("loss_mask"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Formatted conversations with ``turns`` (role, text) and ``learned``, the texts under the mask."""
    keep = [F.col(f"`{c}`") for c in formatted.columns]
    segments = F.filter(F.split("formatted", "<\\|im_end\\|>\n"), lambda s: s != "")
    cut = computed(formatted, keep, _segments=segments)
    body = lambda s: F.substring(s, len(START) + 1, 1 << 30)
    turn = lambda s: F.struct(
        unescaped(F.regexp_extract(body(s), _FIRST_LINE, 1)).alias("role"),
        unescaped(F.regexp_extract(body(s), _FIRST_LINE, 2)).alias("text"),
    )
    inside = lambda m: F.substring(F.col("_segments")[m.turn], m.start + 1, m.end - m.start)
    return computed(
        cut, keep, turns=F.transform("_segments", turn), learned=F.transform("loss_mask", lambda m: unescaped(inside(m)))
    )


def report(formatted: DataFrame) -> DataFrame:
    """Turns, learned texts and lengths of formatted conversations, read back from them."""
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = F.array_join("learned", "")
    return read_turns(formatted).select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _turn_id(turn: str) -> Column:
    return F.coalesce(F.col(turn).cast("long").cast("string"), F.lit("none"))


def messages_of_turns(conversations: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text as messages: a turn is one, of as many rows as have its number."""
    return conversations.select(F.col("conv_id").alias("tree_id"), _turn_id("turn").alias("message_id"), "role", "text")


def replies_of_turns(conversations: DataFrame) -> DataFrame:
    """Each turn as a reply to the turn before it; rows without a turn number come first.

    Turns are ordered in blocks of TURN_BLOCK numbers; the first of a block follows the
    last of the block before, so no window holds a whole long conversation.
    """
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn")).distinct()
    blocked = turns.withColumn("block", F.floor(F.col("turn") / TURN_BLOCK))
    by_block = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block"))
    lasts = blocked.groupBy("conv_id", "block").agg(F.struct(F.max("turn").alias("turn")).alias("last"))
    carried = lasts.select("conv_id", "block", F.lag("last").over(by_block).alias("carried"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"))
    joined = blocked.withColumn("before", F.lag(F.struct("turn")).over(inside)).alias("t").join(
        carried.alias("c"),
        F.col("t.conv_id").eqNullSafe(F.col("c.conv_id")) & F.col("t.block").eqNullSafe(F.col("c.block")),
    )
    return joined.select(
        F.col("t.conv_id").alias("tree_id"), "turn", F.coalesce("before", "carried").alias("parent")
    ).select(
        "tree_id", _turn_id("turn").alias("message_id"),
        F.when(F.col("parent").isNotNull(), _turn_id("parent.turn")).alias("parent_id"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Formatted conversations of a table of turns (conv_id, turn, role, text)."""
    return format_branches(messages_of_turns(conversations), replies_of_turns(conversations))


#: Turns of the conversation that the query adds: its texts are control strings.
_CONTROL_TEXT = f"{END}{START}{LEARNED} ok"


def with_control_conversation(conversations: DataFrame) -> DataFrame:
    """The conversations and one with id -1 whose user and assistant say control strings."""
    one = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"), F.lit(_CONTROL_TEXT).alias("text"),
    )
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).unionByName(one)


def _sql_escaped(text: str) -> str:
    return f"replace(replace({text}, '\\', '\\\\'), '<|', '<\\|')"


ORACLE = f"""
WITH every AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{_CONTROL_TEXT}'
    UNION ALL SELECT -1, 1, '{LEARNED}', '{_CONTROL_TEXT}'
), said AS (
    SELECT conv_id, turn, role, text, role = '{LEARNED}' AS learned,
        {len(START) + 1 + len(END) + 1} + length({_sql_escaped("role")}) + length(role) - length(replace(role, chr(10), ''))
            + length({_sql_escaped("text")}) AS chars
    FROM every
), joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(CASE WHEN learned THEN text END, '' ORDER BY turn, role, text), '') AS loss
    FROM said GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
    sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""
