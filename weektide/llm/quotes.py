"""Chat formatting: conversations in reply order, without the quotes.

Method: quotation linking. The ``>`` marks before a line give its quote level; neighbouring lines of one level are
a passage, whatever its lines' width. The normalised words of a quoted passage are hashed in runs of ``RUN`` words
(all of them, if it has fewer) and joined to the message of the conversation that first wrote that run; a passage of
which half the runs were written earlier is a quote, and a message answers the one that it quotes most. Quoted
passages that nobody wrote stay in the text. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weektide.llm._shared import staged
from weektide.operators.ordered import with_computed

#: Words of a run.
RUN = 5
_MARKS = r"^(?:[ \t]*>)+"
#: A line that announces the quote below it.
_INTRODUCES = r"(?i)^(?:on|am|le|el)\b.*(?:wrote|schrieb|écrit|escribió)[^:]*:\s*$"


def _levels(text: Column) -> Column:
    """raw, level (number of marks) and text of each line."""
    return F.transform(
        F.split(text, r"\r\n|\n|\r"),
        lambda line: F.struct(
            line.alias("raw"),
            F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, _MARKS + "[ \t]?", "").alias("text"),
        ),
    )


def _with_passages(rows: DataFrame) -> DataFrame:
    """``rows`` with passages: level, lines (raw and without marks), words and their hash."""
    # Each step is evaluated once per row, not once for each element of an array that looks it up.
    rows = with_computed(rows, {"lines": _levels(F.col("text"))})
    starts = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda k: (k == 0) | (F.get("lines", k)["level"] != F.get("lines", k - 1)["level"]),
    )
    rows = with_computed(rows, {"starts": F.when(F.col("text").isNotNull(), starts)})
    cut = lambda s, i: F.slice("lines", s + 1, F.coalesce(F.get("starts", i + 1), F.size("lines")) - s)
    rows = with_computed(rows, {"parts": F.transform("starts", cut)}).drop("lines", "starts")

    def own(part: Column, k: Column) -> Column:
        """The lines that count as the passage's words: not one that announces the quote below it."""
        announces = (part[0]["level"] == 0) & F.element_at(part, -1)["text"].rlike(_INTRODUCES) & (k + 1 < F.size("parts"))
        return F.when(announces, F.slice(part, 1, F.size(part) - 1)).otherwise(part)

    def passage(part: Column, k: Column) -> Column:
        words = F.filter(F.split(F.lower(F.array_join(own(part, k)["text"], " ")), r"\s+"), lambda w: w != "")
        return F.struct(part[0]["level"].alias("level"), part["raw"].alias("raw"), own(part, k)["raw"].alias("own"), words.alias("words"))

    rows = with_computed(rows, {"told": F.transform("parts", passage)}).drop("parts", "text")
    named = lambda p: p.withField("key", F.xxhash64(p["level"], F.array_join(p["words"], " ")))
    return with_computed(rows, {"passages": F.transform("told", named)}).drop("told")


def _runs(words: Column, k: Column) -> Column:
    """Hashes of all runs of ``k`` words."""
    run = lambda i: F.array_join(F.slice(words, i + 1, k), " ")
    hashed = lambda i: F.struct(F.xxhash64(run(i)).alias("h1"), F.xxhash64(F.lit("run"), run(i)).alias("h2"))
    return F.transform(F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)), hashed)


def reply_order(messages: DataFrame) -> DataFrame:
    """One row for each row of ``messages`` (conv_id, turn, role, text), sorted by conv_id, root_turn and turn.

    Columns: conv_id, turn, role, text (without linked quotes and the lines that announce them, blank edges
    trimmed), parent_turn (the earlier message that the lowest linked quote level quotes most; of several the
    latest; null without one), root_turn (where the chain of parents begins; the own turn without a parent), depth
    (length of that chain), n_quoted and n_linked (quoted passages with words, and those of which at least
    half the runs were first written in earlier turns). Parents precede their answers in that order. Other
    columns are ignored. A null text stays null and an empty one empty; a null conv_id or turn links with
    nothing; repeated rows keep their rows, and count together as one message; an empty table gives an empty
    result.
    """
    rows = _with_passages(messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"))
    told = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode("passages").alias("p"))
    told = told.where("size(p.words) > 0").select("conv_id", "turn", "p.level", "p.key", "p.words")
    # Repeated rows, and a passage that a message quotes twice, count once.
    quoted = told.where("level > 0").dropDuplicates(["conv_id", "turn", "key"])
    quoted = quoted.withColumn("k", F.least(F.lit(RUN), F.size("words")))
    quoted = staged(quoted.select("conv_id", "turn", "level", "key", "k", _runs(F.col("words"), F.col("k")).alias("runs")), "quoted")
    # Only conversations with quotes need their messages' runs, and only of the lengths that are quoted.
    needed = quoted.select("conv_id", "k").distinct()
    written = told.where("level = 0").join(needed, "conv_id")
    written = written.select("conv_id", "turn", "k", F.explode(_runs(F.col("words"), F.col("k"))).alias("run"))
    keys = ["conv_id", "k", "h1", "h2"]
    # One writer for each run of a conversation, folded before the shuffle: the join adds no rows.
    writers = written.select("conv_id", "k", "run.*", "turn").groupBy(keys).agg(F.min("turn").alias("writer"))
    asked = quoted.select("conv_id", "turn", "level", "key", "k", F.size("runs").alias("n_runs"), F.explode("runs").alias("run"))
    asked = asked.select("conv_id", "turn", "level", "key", "k", "n_runs", "run.*")
    found = asked.join(staged(writers, "writers"), keys).where("writer < turn")
    found = found.groupBy("conv_id", "turn", "level", "key", "n_runs", "writer").agg(F.count("*").alias("n"))
    found = staged(found, "found")
    whole = found.groupBy("conv_id", "turn", "key").agg(F.sum("n").alias("held"), F.max("n_runs").alias("n_runs"))
    linked = staged(whole.where("2 * held >= n_runs").select("conv_id", "turn", "key"), "linked")
    votes = found.join(linked, ["conv_id", "turn", "key"]).groupBy("conv_id", "turn", "level", "writer").agg(F.sum("n").alias("n"))
    votes = votes.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("level"), "n", "writer"))["writer"].alias("parent_turn")
    )
    votes = staged(votes, "parents")
    quotes = linked.groupBy("conv_id", "turn").agg(F.collect_set("key").alias("quotes"))
    told_of = votes.join(_roots(votes), ["conv_id", "turn"]).join(quotes, ["conv_id", "turn"])
    out = rows.join(staged(told_of, "told"), ["conv_id", "turn"], "left")
    is_quote = lambda p: (p["level"] > 0) & F.coalesce(F.array_contains("quotes", p["key"]), F.lit(False))

    def left(p: Column, k: Column) -> Column:
        below = F.get("passages", k + 1)
        kept = F.when(F.coalesce(is_quote(below), F.lit(False)), p["own"]).otherwise(p["raw"])
        return F.when(is_quote(p), F.array().cast("array<string>")).otherwise(kept)

    some = F.filter("passages", lambda p: (p["level"] > 0) & (F.size(p["words"]) > 0))
    return out.select(
        "conv_id",
        "turn",
        "role",
        F.regexp_replace(F.array_join(F.flatten(F.transform("passages", left)), "\n"), r"\A\s+|\s+\z", "").alias("text"),
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce(F.size(some), F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce(F.size(F.filter(some, is_quote)), F.lit(0)).cast("long").alias("n_linked"),
    ).orderBy("conv_id", "root_turn", "turn")


def _roots(parents: DataFrame) -> DataFrame:
    """conv_id, turn, root_turn and depth of every message with a parent; each round doubles the chains."""
    now = parents.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth"))
    while True:
        above = now.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"))
        seen = Observation()
        step = now.join(above, ["conv_id", "root_turn"], "left").observe(seen, F.count("next").alias("moved"))
        now = staged(
            step.select(
                "conv_id", "turn", F.coalesce("next", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "roots",
        )
        if not seen.get["moved"]:
            return now
