"""Quotation linking: who answers what, and conversations without the quotes.

The marks at the start of a line give its quote level; lines of one level up to a blank line
are a passage. Quoted passages are normalised, hashed, and joined to messages in which the
same words stand unquoted: in the same conversation the last such message before, else the first
such message of an earlier conversation. A message answers the original of the first linked
passage among those it quotes least deeply.

Messages come as rows with their thread, depth and turn; by these, every message comes after
the one it answers. No conversation is gathered into one value or task. Originals are
looked up by aggregates and an as-of window per passage and conversation, over passages
that someone quotes only, so a phrase that very many messages share makes no pairs.

Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import kept

LEAST_WORDS = 3  # a shorter passage, such as a greeting, tells nothing about where it is from
_LINE = "\r\n|\r|\n"
_MARKS = r"^[ \t]*(>[ \t]*)+"
_QUOTED_LINES = r"(?m)^[ \t]*>[^\r\n]*(\r\n|\r|\n|$)"


def normalised(text: Column) -> Column:
    """Letters and digits in small letters, single spaces between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def unquoted(text: Column) -> Column:
    """The text without its quoted lines, and without white space around it."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), _QUOTED_LINES, ""), r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """(m, conv, turn, level, first, h1, h2) of every passage of LEAST_WORDS or more, and of each whole unquoted text.

    ``messages`` has m (names the message), conv, turn and text; ``first`` is the line where the passage begins.
    """
    lines = messages.select("m", "conv", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), _LINE)).alias("line", "words"))
    marks = F.regexp_extract("words", _MARKS, 0)
    lines = lines.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", ""))).withColumn("words", normalised(F.col("words")))
    message = Window.partitionBy("m").orderBy("line")
    level, words = F.lag("level").over(message), F.lag("words").over(message)
    lines = lines.withColumn("opens", (F.coalesce(level, F.lit(-1)) != F.col("level")) | (F.col("words") == "") | (F.coalesce(words, F.lit("")) == ""))
    lines = lines.withColumn("run", F.sum(F.col("opens").cast("int")).over(message)).where("words <> ''")
    runs = lines.groupBy("m", "conv", "turn", "level", "run").agg(F.sort_array(F.collect_list(F.struct("line", "words"))).alias("lines"))
    runs = runs.select("m", "conv", "turn", "level", F.col("lines")[0]["line"].alias("first"), F.array_join("lines.words", " ").alias("words"))
    whole = messages.select("m", "conv", "turn", F.lit(0).alias("level"), F.lit(0).alias("first"), normalised(unquoted(F.col("text"))).alias("words"))
    both = runs.union(whole).where(F.size(F.split("words", " ")) >= LEAST_WORDS)
    return both.select("m", "conv", "turn", "level", "first", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit("second"), "words").alias("h2"))


def _answers(found: DataFrame) -> DataFrame:
    """The message each message answers: m, and its conv and turn as p_conv, p_turn; besides n_linked."""
    quotes = found.where("level > 0 and conv is not null and turn is not null")
    hashes = kept(quotes.select("h1", "h2").distinct(), "quoted-hashes")
    own = found.where("level = 0 and conv is not null and turn is not null").join(hashes, ["h1", "h2"], "left_semi")
    own = kept(own.select("h1", "h2", "conv", "turn").distinct(), "quoted-originals")
    first = kept(own.groupBy("h1", "h2").agg(F.min(F.struct("conv", "turn")).alias("earliest")), "quoted-earliest")

    # The last original before each quote, in its conversation.
    asked = quotes.select("h1", "h2", "conv", "turn").distinct()
    line = own.withColumn("original", F.col("turn")).unionByName(asked.withColumn("original", F.lit(None).cast(own.schema["turn"].dataType)))
    before = Window.partitionBy("h1", "h2", "conv").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("here", F.max("original").over(before)).where("original is null").drop("original")

    key = ["h1", "h2", "conv", "turn"]
    linked = quotes.join(line, key).join(first, ["h1", "h2"], "left")
    elsewhere = F.when(F.col("earliest.conv") < F.col("conv"), F.col("earliest"))
    here = F.when(F.col("here").isNotNull(), F.struct("conv", F.col("here").alias("turn")))
    linked = linked.withColumn("origin", F.coalesce(here, elsewhere)).where("origin is not null")
    best = linked.groupBy("m").agg(F.min(F.struct("level", "first", "origin")).alias("best"), F.count("*").alias("n_linked"))
    return kept(best.select("m", F.col("best.origin.conv").alias("p_conv"), F.col("best.origin.turn").alias("p_turn"), "n_linked"), "quote-answers")


def _threads(links: DataFrame) -> DataFrame:
    """The first message and the depth of each linked place: conv, turn, r_conv, r_turn, depth.

    An answer comes after its original, in its conversation or by the number of that, so links form trees;
    roots are reached twice as far in each step.
    """
    reach = kept(links.withColumn("depth", F.lit(1).cast("long")), "threads")
    while True:
        up = reach.select(F.col("conv").alias("r_conv"), F.col("turn").alias("r_turn"), F.col("r_conv").alias("u_conv"), F.col("r_turn").alias("u_turn"), F.col("depth").alias("more"))
        step = reach.join(up, ["r_conv", "r_turn"], "left")
        step = kept(
            step.select(
                "conv",
                "turn",
                F.coalesce("u_conv", "r_conv").alias("r_conv"),
                F.coalesce("u_turn", "r_turn").alias("r_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                "more",
            ),
            "threads",
        )
        reach = step.drop("more")
        if step.where("more is not null").isEmpty():
            return reach


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``messages`` with text replaced by what is not quoted, and n_quotes, n_linked, parent and thread places, and depth.

    ``parent_conv`` and ``parent_turn`` name the message answered, null for one that quotes nothing known; ``thread_conv``
    and ``thread_turn`` the first message of its thread, itself if it has no parent; depth counts answers from there.
    In a thread, (depth, turn) puts every message after the one it answers. Null texts count as empty; a message without
    conversation or turn is linked with nothing. Of several messages in one place the one that answers the earliest
    place tells the thread of all. Equal rows are one message and each is listed. An empty table gives an empty
    one. Other columns pass through, whatever their names but those of the result and those
    that begin with two underscores.
    """
    # A hash passes over nulls, so it is told where they are.
    known = [x for c in (conv, turn, text) for x in (F.col(c), F.col(c).isNull())]
    named = messages.withColumn("__m", F.struct(F.xxhash64(*known), F.xxhash64(F.lit("second"), *known)))
    plain = named.select(F.col("__m").alias("m"), F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    # The lines of equal rows would run together.
    found = kept(passages(plain.distinct()), "quote-passages")
    answers = _answers(found)
    places = plain.select("m", "conv", "turn").distinct().join(answers, "m")
    links = places.groupBy("conv", "turn").agg(F.min(F.struct("p_conv", "p_turn")).alias("one"))
    threads = _threads(links.select("conv", "turn", F.col("one.p_conv").alias("r_conv"), F.col("one.p_turn").alias("r_turn")))

    counted = found.where("level > 0").groupBy("m").agg(F.count("*").alias("n_quotes"))
    by_message = counted.join(answers, "m", "left").select(
        F.col("m").alias("__m"), F.col("n_quotes").alias("__q"), F.col("n_linked").alias("__n"), F.col("p_conv").alias("__pc"), F.col("p_turn").alias("__pt")
    )
    tops = threads.select(
        F.col("conv").alias("__c"), F.col("turn").alias("__t"), F.col("r_conv").alias("__rc"), F.col("r_turn").alias("__rt"), F.col("depth").alias("__d")
    )
    joined = named.join(kept(by_message, "quote-messages"), "__m", "left")
    joined = joined.join(tops, (F.col(conv) == F.col("__c")) & (F.col(turn) == F.col("__t")), "left")
    out = {
        text: unquoted(F.col(text)),
        "n_quotes": F.coalesce("__q", F.lit(0)),
        "n_linked": F.coalesce("__n", F.lit(0)),
        "parent_conv": F.col("__pc"),
        "parent_turn": F.col("__pt"),
        "thread_conv": F.coalesce("__rc", conv),
        "thread_turn": F.coalesce("__rt", turn),
        "depth": F.coalesce("__d", F.lit(0)),
    }
    return joined.withColumns(out).drop("__m", "__q", "__n", "__pc", "__pt", "__c", "__t", "__rc", "__rt", "__d")


def op5_quote_links(conversations: DataFrame) -> DataFrame:
    return link_quotes(conversations.select("conv_id", "turn", "role", "text"))
