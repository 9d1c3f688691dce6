"""Quotation linking: reply trees from quoted passages, in DataFrame functions only.

A message's quoted lines (``>`` once per level) form passages: runs of lines of
one level.  Lines are normalised (lower case, single blanks) and hashed, and so
are whole passages and the whole own text of every message.  The origin of a
passage is

1. the latest earlier message of its conversation whose own text is the passage;
2. where there is none, of all earlier messages of the conversation and all
   messages of other conversations (which have no order in time) the one that
   holds the largest share of the passage's different lines; ties go to the same
   conversation and there to the latest message, elsewhere to the smallest
   (conv_id, turn).  A passage none of whose lines such a message holds has none.

Level-1 passages name the message replied to; messages without their quotes,
ordered by reply depth, make up the threads.  Where messages quote each other
in a ring, the one with the smallest (conv_id, turn) starts the thread.

The rule is met exactly, without pairing all messages that share a line.  Lines
that few messages hold lead to all of them.  Of frequent lines only the
different sets that passages ask for and that messages hold are compared: a set
stands for all its messages, by its latest earlier one in the conversation and
its first ones elsewhere.  A message with any rarer line of the passage is found
by that line; all others hold just what their set of frequent lines holds.

Defined results: a null text is an empty message; repeated rows give repeated
rows; rows that repeat an id with another text are origins of their own;
messages with a null id neither quote nor are quoted and are threads of
their own (with null thread columns); deeper levels may skip (a lone ``> > x``);
an empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import cut, with_position

# A quoted line, and an attribution before a quote.  ``d`` makes \n the only line
# end; no pattern repeats a group, so none recurses on long runs of markers.
_QUOTED = r"(?md)^[\x20]?>.*(?:\n|\z)"
_ATTRIBUTION = r"(?md)^[^\n>][^\n]*\bwrote:[\x20]*\n(?=[\x20]?>)"
_BLANK = " \t\r\n"

FREQUENT = 64  # a line that more messages hold is compared by sets
TURNS = 1024   # turns of a conversation that are looked through by one task at a time


def body(text: Column) -> Column:
    """A message without quoted lines and their attributions, trimmed."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, _ATTRIBUTION, ""), _QUOTED, ""), F.lit(_BLANK))


def markers(line: Column) -> Column:
    """The quote markers a line begins with: ``>``, each with at most one blank before it."""
    lead = F.substring_index(F.regexp_extract(line, r"^[\x20>]*+", 0), "  ", 1)
    return F.rtrim(lead)


def normalised(line: Column) -> Column:
    """Lower case, blanks collapsed, quote markers gone."""
    return F.trim(F.regexp_replace(F.lower(F.substr(line, F.length(markers(line)) + 1)), r"\s+", " "))


def with_passages(messages: DataFrame, text: str = "__text") -> DataFrame:
    """``messages`` with ``found``, an array of (level, lines): runs of quoted lines of one level
    (the number of markers), normalised, without blank lines, by level, then place.

    Linear in the text, whatever its nesting: lines are levelled once, a run starts where
    the level changes, and each run is cut out once.
    """
    lined = messages.withColumn("__lines", F.split(F.col(text), "\n"))
    # The arrays become columns of their own before they are indexed from a lambda.
    lined = lined.withColumn("__levels", F.transform("__lines", lambda x: F.length(F.replace(markers(x), F.lit(" "), F.lit("")))))
    lined = lined.withColumn("__starts", F.filter(F.sequence(F.lit(0), F.size("__lines") - 1), lambda i: (i == 0) | (
        F.get("__levels", i) != F.get("__levels", i - 1))))
    runs = F.transform("__starts", lambda i, k: F.struct(
        F.get("__levels", i).alias("level"), i.alias("at"), (F.coalesce(F.get("__starts", k + 1), F.size("__lines")) - i).alias("n")))
    lined = lined.withColumn("__runs", F.array_sort(F.filter(runs, lambda r: r["level"] > 0)))
    cut_out = F.transform("__runs", lambda r: F.struct(r["level"].alias("level"), F.filter(F.transform(
        F.slice("__lines", r["at"] + 1, r["n"]), normalised), lambda x: x != "").alias("lines")))
    return lined.withColumn("found", F.filter(cut_out, lambda p: F.size(p["lines"]) > 0)).drop("__lines", "__levels", "__starts", "__runs")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(line, F.length(line))


def _whole(lines: Column) -> Column:
    """The hash of an array of hashed lines, null if it is empty."""
    return F.when(F.size(lines) > 0, F.xxhash64(lines, F.size(lines)))


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, lines, whole, passages) for every row; lines and passages are hashed."""
    said = messages.select("conv_id", "turn", "role", F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    cut_up = with_passages(said).select("conv_id", "turn", "role", body(F.col("__text")).alias("body"), "found")
    own = F.filter(F.transform(F.split("body", "\n"), normalised), lambda x: x != "")
    hashed = cut_up.select("conv_id", "turn", "role", "body", F.transform(own, _line_hash).alias("own"), F.transform(
        "found", lambda p: F.struct(p["level"].alias("level"), F.transform(p["lines"], _line_hash).alias("lines"))).alias("found"))
    return hashed.select("conv_id", "turn", "role", "body", F.array_distinct("own").alias("lines"), _whole(F.col("own")).alias("whole"),
                         F.transform("found", lambda p: F.struct(
                             p["level"].alias("level"), F.array_distinct(p["lines"]).alias("lines"), _whole(p["lines"]).alias("whole"),
                             F.xxhash64(p["level"], p["lines"]).alias("quote"))).alias("passages"))


PASSAGE = ["conv_id", "turn", "passage", "quote"]  # one quoted passage; ``quote`` tells rows apart that repeat an id
ORIGIN = ["origin_conv", "origin_turn", "origin_whole"]


def latest_earlier(asked: DataFrame, held: DataFrame) -> DataFrame:
    """``asked`` rows (conv_id, turn, key and more) with ``near``: the largest turn below
    their own that ``held`` (conv_id, turn, key) has for their conversation and key.

    A running maximum by blocks of ``TURNS`` turns, to which the last turn of earlier
    blocks is carried over, so that no task walks through a whole long conversation.
    """
    block = F.floor(F.col("turn") / TURNS).alias("block")
    more = [F.lit(None).cast(f.dataType).alias(f.name) for f in asked.schema if f.name not in ("conv_id", "turn", "key")]
    both = (held.select("conv_id", "turn", "key").distinct().select("conv_id", "turn", "key", *more, F.col("turn").alias("holds"), block)
            .unionByName(asked.select("*", F.lit(None).cast(held.schema["turn"].dataType).alias("holds"), block)
                         .withColumn("__asked", F.lit(True)), allowMissingColumns=True))
    within = Window.partitionBy("conv_id", "key", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("conv_id", "key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (both.groupBy("conv_id", "key", "block").agg(F.max("holds").alias("last"))
               .select("conv_id", "key", "block", F.max("last").over(across).alias("carried")))
    found = both.withColumn("near", F.max("holds").over(within)).filter("__asked")
    return (found.join(carried, ["conv_id", "key", "block"])
            .select(*asked.columns, F.coalesce("near", "carried").alias("near")))


def _set_overlaps(asked: DataFrame, held: DataFrame, by: list[str]) -> DataFrame:
    """(*by, wants, holds, common) for the different sets ``wants`` and ``holds`` with a common line."""
    left = asked.select(*by, "wants").distinct().select(*by, "wants", F.explode("wants").alias("line"))
    right = held.select(*by, "holds").distinct().select(*by, "holds", F.explode("holds").alias("line"))
    return left.join(right, [*by, "line"]).groupBy(*by, "wants", "holds").agg(F.count(F.lit(1)).alias("common"))


def _first_elsewhere(asked: DataFrame, held: DataFrame) -> DataFrame:
    """For every passage the message of another conversation that has most of its frequent lines, the first of equals.

    Each set keeps its first message and the first one of any other conversation; so does each
    set that is asked for, by overlap, and one of its two is not in the passage's conversation.
    """
    at = F.struct(F.col("origin_conv").alias("c"), F.col("origin_turn").alias("t"), F.col("origin_whole").alias("w"))
    firsts = held.groupBy("holds", "origin_conv").agg(F.min(at).alias("at"))
    low = firsts.groupBy("holds").agg(F.min("at").alias("low"))
    second = (firsts.join(low, "holds").filter(F.col("origin_conv") != F.col("low.c"))
              .groupBy("holds").agg(F.min("at").alias("second")))
    met = _set_overlaps(asked, held, []).join(low, "holds").join(second, "holds", "left")
    rank = [F.struct((-F.col("common")).alias("o"), F.col(n).alias("at")) for n in ("low", "second")]
    best = met.groupBy("wants").agg(F.min(rank[0]).alias("best"))
    elsewhere = F.when(F.col("low.c") != F.col("best.at.c"), rank[0]).when(F.col("second").isNotNull(), rank[1])
    other = met.join(best, "wants").groupBy("wants").agg(F.first("best").alias("best"), F.min(elsewhere).alias("other"))
    mine = asked.join(other, "wants").withColumn("r", F.when(F.col("best.at.c") != F.col("conv_id"), F.col("best")).otherwise(F.col("other")))
    return mine.filter("r IS NOT NULL").select(*PASSAGE, F.col("r.at.c").alias("origin_conv"), F.col("r.at.t").alias("origin_turn"),
                                               (-F.col("r.o")).alias("common"))


def _latest_here(asked: DataFrame, held: DataFrame) -> DataFrame:
    """For every passage the earlier message of its conversation that has most of its frequent lines, the latest of equals."""
    here = held.withColumn("conv_id", F.col("origin_conv"))
    first = here.groupBy("conv_id", "holds").agg(F.min("origin_turn").alias("first"))
    met = _set_overlaps(asked, here, ["conv_id"]).join(first, ["conv_id", "holds"])
    open_ = asked.join(met, ["conv_id", "wants"]).filter("first < turn")
    most = open_.withColumn("most", F.max("common").over(Window.partitionBy(*PASSAGE))).filter("common = most")
    near = latest_earlier(most.select(*PASSAGE, "common", F.col("holds").alias("key")),
                          here.select("conv_id", F.col("origin_turn").alias("turn"), F.col("holds").alias("key")))
    return near.select(*PASSAGE, F.col("conv_id").alias("origin_conv"), F.col("near").alias("origin_turn"), "common")


def _by_lines(asked: DataFrame, known: DataFrame, frequent: int) -> DataFrame:
    """(PASSAGE, origin_conv, origin_turn, common) that include, for every passage of ``asked``, its origin by common lines."""
    wanted = asked.select(*PASSAGE, F.explode("lines").alias("line"))
    told = known.select(F.col("conv_id").alias("origin_conv"), F.col("turn").alias("origin_turn"), F.col("whole").alias("origin_whole"),
                        F.explode("lines").alias("line")).distinct()
    told = cut(told.join(wanted.select("line").distinct(), "line", "left_semi"))
    often = told.groupBy("line").count().filter(F.col("count") > frequent).select("line")
    wants = wanted.join(often, "line").groupBy(*PASSAGE).agg(F.array_sort(F.collect_list("line")).alias("wants"))
    holds = told.join(often, "line").groupBy(*ORIGIN).agg(F.array_sort(F.collect_list("line")).alias("holds"))
    wants, holds = cut(wants), cut(holds)
    fits = (F.col("origin_conv") != F.col("conv_id")) | (F.col("origin_turn") < F.col("turn"))
    rare = (wanted.join(told.join(often, "line", "left_anti"), "line").filter(fits)
            .groupBy(*PASSAGE, *ORIGIN).agg(F.count(F.lit(1)).alias("rare")))
    none = F.array().cast("array<long>")
    also = F.size(F.array_intersect(F.coalesce("wants", none), F.coalesce("holds", none)))
    paired = (rare.join(wants, PASSAGE, "left").join(holds, ORIGIN, "left")
              .select(*PASSAGE, "origin_conv", "origin_turn", (F.col("rare") + also).alias("common")))
    return paired.unionByName(_first_elsewhere(wants, holds)).unionByName(_latest_here(wants, holds))


def links(messages: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(conv_id, turn, passage, level, origin_conv, origin_turn, share) for every quoted passage
    of ``parsed`` messages that has an origin.  ``frequent`` does not change the result."""
    known = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoted = (known.select("conv_id", "turn", F.posexplode("passages").alias("passage", "p")).select("conv_id", "turn", "passage", "p.*")
              .dropDuplicates(PASSAGE))
    whole = known.filter("whole IS NOT NULL").select("conv_id", "turn", F.col("whole").alias("key"))
    found = cut(latest_earlier(quoted.withColumnRenamed("whole", "key"), whole))
    rest = found.filter("near IS NULL")
    told = found.filter("near IS NOT NULL").select("conv_id", "turn", "passage", "quote", "level", F.col("conv_id").alias("origin_conv"),
                                                   F.col("near").alias("origin_turn"), F.lit(1.0).alias("share"))
    same = F.col("origin_conv") == F.col("conv_id")
    order = F.struct("common", same, F.when(same, F.col("origin_turn")), -F.col("origin_conv"), -F.col("origin_turn"))
    best = _by_lines(rest, known, frequent).groupBy(*PASSAGE).agg(
        F.max_by(F.struct("origin_conv", "origin_turn", "common"), order).alias("best"))
    shared = rest.join(best, PASSAGE).select(*PASSAGE, "level", "best.origin_conv", "best.origin_turn",
                                             (F.col("best.common") / F.size("lines")).alias("share"))
    return told.unionByName(shared).drop("quote")


def reply_trees(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_conv, thread_turn, depth) from (conv_id, turn, parent_conv, parent_turn).

    Pointer doubling: a round moves every message that has not met its root yet
    to the ancestor of its current ancestor, so a thread of n levels takes
    log2 n rounds, and messages of short threads rest while long ones go on.
    Messages that are on their way after twice as many steps as there are messages
    go round a ring: its smallest message becomes a root, and they start anew.
    """
    here = F.struct("conv_id", "turn")
    reply = F.col("parent_conv").isNotNull()
    parent = F.struct(F.col("parent_conv").alias("conv_id"), F.col("parent_turn").alias("turn"))
    # ``low`` is the smallest message from ``id`` up to, but without, ``up``
    state = cut(parents.select(here.alias("id"), F.when(reply, parent).otherwise(here).alias("up"),
                               F.when(reply, 1).otherwise(0).cast("long").alias("depth"), reply.alias("open"), here.alias("low")))
    steps, messages = 1, state.count()
    while not state.filter("open").isEmpty():
        if steps > 2 * messages:  # the last round only finds that a root is met
            on_ring = state.filter("open").select(F.col("up").alias("id")).distinct()
            roots = state.join(on_ring, "id", "left_semi").select("low.conv_id", "low.turn").distinct().withColumn("root", F.lit(True))
            cut_rings = parents.join(roots, ["conv_id", "turn"], "left").select(
                "conv_id", "turn", F.when(F.col("root").isNull(), F.col("parent_conv")).alias("parent_conv"),
                F.when(F.col("root").isNull(), F.col("parent_turn")).alias("parent_turn"))
            return reply_trees(cut(cut_rings))
        above = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("low").alias("least"))
        moved = (state.filter("open").join(above, "up")
                 .select("id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("open"),
                         F.least("low", "least").alias("low")))
        state = cut(state.filter("NOT open").unionByName(moved))
        steps *= 2
    return state.select("id.conv_id", "id.turn", F.col("up.conv_id").alias("thread_conv"), F.col("up.turn").alias("thread_turn"), "depth")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Every message without quotes, in its thread: (conv_id, turn, role, body, n_quotes,
    parent_conv, parent_turn, share, thread_conv, thread_turn, depth, reply_no).

    ``reply_no`` numbers a thread's messages by (depth, conv_id, turn) from 1.
    """
    known = cut(parsed(messages))
    same = F.col("origin_conv") == F.col("conv_id")
    best = F.max_by(F.struct("origin_conv", "origin_turn", "share"),
                    F.struct("share", same, F.when(same, F.col("origin_turn")), -F.col("origin_conv"), -F.col("origin_turn")))
    parent = (links(known).filter("level = 1").groupBy("conv_id", "turn").agg(best.alias("b"))
              .select("conv_id", "turn", F.col("b.origin_conv").alias("parent_conv"), F.col("b.origin_turn").alias("parent_turn"),
                      "b.share"))
    ids = known.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    nodes = cut(ids.join(parent, ["conv_id", "turn"], "left"))
    placed = with_position(reply_trees(nodes), ["thread_conv", "thread_turn", "depth", "conv_id", "turn"], "position")
    first = placed.groupBy("thread_conv", "thread_turn").agg(F.min("position").alias("first"))
    numbered = (placed.join(first, ["thread_conv", "thread_turn"]).join(nodes, ["conv_id", "turn"])
                .withColumns({c: F.when(F.col("depth") > 0, F.col(c)) for c in ("parent_conv", "parent_turn", "share")})
                .withColumn("reply_no", F.col("position") - F.col("first") + 1).drop("position", "first"))
    own = known.select("conv_id", "turn", "role", "body", F.size("passages").alias("n_quotes"))
    return own.join(numbered, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "body", "n_quotes", "parent_conv", "parent_turn", "share", "thread_conv", "thread_turn", "depth",
        "reply_no")


def as_replies(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn quotes the whole text of the turn before,
    and that of the turn before that one level deeper, above its own text."""
    whole = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(_BLANK))
    said = conversations.select("conv_id", "turn", F.col("role").alias("by"), whole.alias("said"))

    def back(n: int) -> DataFrame:
        return said.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("by").alias(f"by{n}"), F.col("said").alias(f"said{n}"))

    def quoted(name: str, mark: str, end: str) -> Column:
        return F.when(F.coalesce(F.col(name), F.lit("")) != "", F.concat(
            F.lit(mark), F.replace(F.col(name), F.lit("\n"), F.lit("\n" + mark)), F.lit(end))).otherwise("")

    joined = conversations.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    quote = F.when(F.coalesce(F.col("said1"), F.lit("")) != "", F.concat(
        F.coalesce("by1", F.lit("someone")), F.lit(" wrote:\n"), quoted("said2", "> > ", "\n"), quoted("said1", "> ", "\n\n"))).otherwise("")
    return joined.select("conv_id", "turn", "role", F.concat(quote, F.coalesce("text", F.lit(""))).alias("text"))
