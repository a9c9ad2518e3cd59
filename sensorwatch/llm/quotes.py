"""Conversations without quotations: quoted passages are linked to the messages they come from.

1. Lines are read as mail clients write them: `>` marks, nested, before a quoted line; a line that ends in `wrote:` or `schrieb:` and the like
   just before a quotation is its attribution. A passage is a run of lines of one quote level.
2. Passages, and the lines and paragraphs of every message's own words, are normalised (A-Z lowered, runs of anything but letters and
   digits made one blank) and hashed.
3. A quoted passage joins the message that holds it: in its own conversation the latest earlier turn, else the first one anywhere (smallest conversation
   and turn), which is aggregated per hash before the join, so that a passage held by very many messages joins as one row.
4. A message answers the latest turn that its outermost linked quotation comes from, else the turn before it. Depth and root are found by
   doubling: each round joins every message with the one its pointer has reached, so a conversation of n turns takes log2(n) rounds.

Only DataFrame functions run here. Defined cases: a null or empty text has no lines and no quotations. A repeated (conversation, turn) counts
once, with the smallest role and text. Rows with a null conversation or turn come back unlinked, with the reply columns null. A quotation
shorter than MIN_CHARS after normalisation, or one that no message holds, is removed from the text and counted, but links nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwatch.llm.common import BLANKS, ascii_lower, staged

MIN_CHARS = 12
QUOTED = r"^[ \t]*>[> \t]*"
#: Closing words of attribution lines.
ATTRIBUTION = r"(?i)(?:wrote|writes|said|schrieb|escribió|a écrit)[ ]*:[ \t]*$"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(text), r"[^\p{L}\p{M}\p{Nd}]+", " "))


def level(line: Column) -> Column:
    """Number of quote marks before the line's words."""
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTED, 0), "[^>]", ""))


def _hash(text: Column) -> Column:
    return F.when(F.length(text) >= MIN_CHARS, F.md5(text.cast("binary")))


def parsed(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """messages with `body` (its own words) and `passages`: place, level and normalised text of each quoted passage."""
    lines = F.split(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "\r\n?", "\n"), "\n", -1)
    shaped = F.transform(lines, lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, QUOTED, "").alias("line")))
    rows = messages.withColumn("_lines", F.when(F.col(text_col).contains(">"), shaped))
    # A plain message has one way to be read.
    keeps = lambda x, i: (x["level"] == 0) & ~(x["line"].rlike(ATTRIBUTION) & (F.coalesce(F.get("_lines", i + 1)["level"], F.lit(0)) > 0))
    own = F.array_join(F.transform(F.filter("_lines", keeps), lambda x: x["line"]), "\n")
    start = F.array().cast("array<struct<place:int,level:int,text:string>>")

    def add(state: Column, x: Column) -> Column:
        last = F.get(state, F.size(state) - 1)
        goes_on = F.coalesce(last["level"] == x["level"], F.lit(False))
        one = F.struct(F.size(state).alias("place"), x["level"].alias("level"), x["line"].alias("text"))
        more = F.struct(last["place"].alias("place"), last["level"].alias("level"), F.concat_ws("\n", last["text"], x["line"]).alias("text"))
        grown = F.concat(F.slice(state, F.lit(1), F.greatest(F.size(state) - 1, F.lit(0))), F.array(more))
        return F.when(goes_on, grown).otherwise(F.concat(state, F.array(one))).cast("array<struct<place:int,level:int,text:string>>")

    runs = F.filter(F.aggregate("_lines", start, add), lambda x: x["level"] > 0)
    rows = rows.withColumn("body", F.btrim(F.coalesce(F.when(F.col("_lines").isNotNull(), own), F.col(text_col), F.lit("")), F.lit(BLANKS)))
    return rows.withColumn("passages", F.coalesce(runs, start)).drop("_lines")


def _units(body: Column) -> Column:
    """Hashes of the whole body, its paragraphs and its lines, each once."""
    parts = F.concat(F.array(body), F.split(body, r"\n[ \t]*\n", -1), F.split(body, "\n", -1))
    return F.array_distinct(F.array_compact(F.transform(parts, lambda x: _hash(normalised(x)))))


def linked_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role") -> DataFrame:
    """A row for each message: its own words, its quotations, what it answers, its depth and root.

    conv_id, turn, role, n_quotes, max_level, quoted (array of level, conv_id, turn of the linked passages, in order), reply_turn (null for a
    root), depth, root_turn, body. Ordered by (conv_id, root_turn, depth, turn), a conversation reads as its threads.
    """
    named = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    once = named.where(known).groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("m")).select("conv_id", "turn", "m.role", "m.text")
    rows = staged(parsed(once.unionByName(named.where(~known))).drop("text"), "parsed")
    placed = rows.where(known)
    quoted = placed.where(F.size("passages") > 0).select("conv_id", "turn", F.explode("passages").alias("p"))
    quoted = staged(quoted.select("conv_id", "turn", "p.place", "p.level", _hash(normalised(F.col("p.text"))).alias("hash")).where("hash is not null"), "quoted")
    # Only hashes that some message quotes are looked for.
    wanted = quoted.select("hash").distinct()
    units = placed.where("body <> ''").select(F.col("conv_id").alias("conv"), F.col("turn").alias("at"), F.explode(_units(F.col("body"))).alias("hash"))
    units = staged(units.join(wanted, "hash", "left_semi"), "units")
    here = quoted.join(units, (quoted["hash"] == units["hash"]) & (F.col("conv") == F.col("conv_id")) & (F.col("at") < F.col("turn")))
    here = here.groupBy("conv_id", "turn", "place").agg(F.max("at").alias("near"))
    first = units.groupBy("hash").agg(F.min(F.struct("conv", "at")).alias("first"))
    links = quoted.join(here, ["conv_id", "turn", "place"], "left").join(first, "hash", "left")
    other = F.when((F.col("first.conv") != F.col("conv_id")) | (F.col("first.at") < F.col("turn")), F.col("first"))
    links = links.select("conv_id", "turn", "place", "level", F.when(F.col("near").isNotNull(), F.struct(F.col("conv_id").alias("conv"), F.col("near").alias("at"))).otherwise(other).alias("of"))
    links = links.where("of is not null").groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("place", "level", "of"))).alias("found"))
    in_conv = F.filter("found", lambda x: (x["of"]["conv"] == F.col("conv_id")) & (x["of"]["at"] < F.col("turn")))
    outer = F.filter(in_conv, lambda x: x["level"] == F.array_min(F.transform(in_conv, lambda y: y["level"])))
    answered = F.array_max(F.transform(outer, lambda x: x["of"]["at"]))
    links = links.select("conv_id", "turn", F.transform("found", lambda x: F.struct(x["level"].alias("level"), x["of"]["conv"].alias("conv_id"), x["of"]["at"].alias("turn"))).alias("quoted"), answered.alias("answered"))
    return _threads(rows, placed, links)


def _threads(rows: DataFrame, placed: DataFrame, links: DataFrame) -> DataFrame:
    turns = placed.select("conv_id", "turn")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("previous"))
    reply = turns.join(before, ["conv_id", "turn"], "left").join(links.select("conv_id", "turn", "answered"), ["conv_id", "turn"], "left")
    reply = staged(reply.select("conv_id", "turn", F.coalesce("answered", "previous").alias("reply_turn")), "replies")
    is_root = F.col("reply_turn").isNull()
    pointer = reply.select("conv_id", "turn", F.coalesce("reply_turn", "turn").alias("reached"), (~is_root).cast("long").alias("depth"), is_root.alias("done"))
    while True:
        pointer = staged(pointer, "pointers")
        under_way = pointer.where("not done").drop("done")
        if under_way.isEmpty():
            break
        # A message that has reached its root rests; the others go on from where the message they have reached has got to.
        hop = pointer.select("conv_id", F.col("turn").alias("reached"), F.col("reached").alias("further"), F.col("depth").alias("more"), "done")
        moved = under_way.join(hop, ["conv_id", "reached"]).select("conv_id", "turn", F.col("further").alias("reached"), (F.col("depth") + F.col("more")).alias("depth"), "done")
        pointer = pointer.where("done").unionByName(moved)
    pointer = pointer.drop("done")
    out = rows.join(reply, ["conv_id", "turn"], "left").join(pointer.withColumnRenamed("reached", "root_turn"), ["conv_id", "turn"], "left")
    out = out.join(links.select("conv_id", "turn", "quoted"), ["conv_id", "turn"], "left")
    levels = F.array_max(F.transform("passages", lambda x: x["level"]))
    none = F.array().cast("array<struct<level:int,conv_id:bigint,turn:bigint>>")
    return out.select(
        "conv_id", "turn", "role", F.size("passages").cast("long").alias("n_quotes"), F.coalesce(levels, F.lit(0)).alias("max_level"), F.coalesce("quoted", none).alias("quoted"),
        "reply_turn", "depth", "root_turn", "body",
    )
