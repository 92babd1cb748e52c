"""Conversations put in reply order by linking quotations to the messages they come from.

A line that starts with `>` marks is quoted, as deep as it has marks; the lines of one depth that follow each other form a
passage. Passages and unquoted text are normalised (lower case, blanks in one) and cut into sentences, whose hashes are
joined: a quoted sentence comes from the first message of its conversation that says it unquoted. A message replies to the
message from which most of its least deep linked sentences come. Messages that quote nothing start a thread of their own.

All of it is joins and sums over narrow rows: no step gathers a conversation, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.llm.tables import others, stored

OUTPUTS = ("clean_text", "formatted", "n_quoted", "n_linked", "reply_to", "root", "depth", "path")
MARKS = r"^[ \t]*(?:>[ \t]?)+"
MOST_ROUNDS = 60  # pointer doubling: chains of up to 2 ** 60 replies


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def sentences(text: Column) -> Column:
    """Hashes of the sentences of a normalised text; empty ones don't count."""
    parts = F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda x: x != "")
    return F.transform(parts, lambda x: F.substring(F.sha2(x, 256), 1, 32))


def lines(text: Column) -> Column:
    """The lines of a text as structs of depth and body."""
    return F.transform(F.split(text, "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("depth"),
        F.regexp_replace(x, MARKS, "").alias("body")))


def passages(quoting: DataFrame) -> DataFrame:
    """_conv, _turn, depth and text of the quoted passages of each message: runs of lines of the same depth."""
    rows = quoting.select("_conv", "_turn", F.sha2("_text", 256).alias("_key"), F.posexplode(lines(F.col("_text"))).alias("at", "line")).select(
        "_conv", "_turn", "_key", "at", F.col("line.depth").alias("depth"), F.col("line.body").alias("body")).distinct()
    same = Window.partitionBy("_conv", "_turn", "_key", "depth").orderBy("at")  # the lines of one message
    runs = rows.filter("depth > 0").withColumn("run", F.col("at") - F.row_number().over(same))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " ")
    return runs.groupBy("_conv", "_turn", "_key", "depth", "run").agg(joined.alias("text"))


def link(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`messages` with the columns of OUTPUTS, which replace columns of these names.

    clean_text: the text without quoted lines. formatted: `role: clean_text`. n_quoted and n_linked: quoted sentences, and
    those found in an earlier message. reply_to: the turn that is answered (NULL: none). root, depth, path: first turn of
    the thread, steps from it, and all turns on the way; ordering by conversation and path gives the reply order.

    A NULL text is empty. Messages with a NULL conversation or turn are kept and linked to nothing (their path is
    their turn alone). Rows of one conversation and turn are one message in links: each gets the links of all of them.
    Ties of linked sentences go to the latest of the earlier turns; a message never replies to itself or a later one.
    """
    key = [F.col(f"`{conversation}`").alias("_conv"), F.col(f"`{turn}`").cast("long").alias("_turn")]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    quotes = F.rlike(whole, F.lit("(?m)" + MARKS))
    base = messages.select(*key, whole.alias("_text"), quotes.alias("_quotes")).filter("_conv IS NOT NULL AND _turn IS NOT NULL")
    quoting = base.filter("_quotes")
    quoted = passages(quoting).select("_conv", "_turn", F.col("depth").alias("_depth"), F.explode(sentences(normal(F.col("text")))).alias("_hash"))
    quoted = stored(quoted, "quoted")
    spoken = base.join(quoted.select("_conv").distinct(), "_conv", "left_semi")
    said = spoken.select("_conv", "_turn", F.explode(F.array_distinct(sentences(normal(clean(F.col("_text")))))).alias("_hash"))
    wanted = quoted.groupBy("_conv", "_hash").agg(F.max("_turn").alias("_last"))
    first = said.groupBy("_conv", "_hash").agg(F.min("_turn").alias("_source"))  # partly summed before the shuffle
    found = quoted.join(first.join(wanted, ["_conv", "_hash"], "left_semi"), ["_conv", "_hash"], "left")
    earlier = F.when(F.col("_source") < F.col("_turn"), F.col("_source"))
    votes = found.withColumn("_source", earlier).groupBy("_conv", "_turn", "_depth", "_source").agg(F.count(F.lit(1)).alias("_n"))
    counted = votes.groupBy("_conv", "_turn").agg(
        F.sum("_n").alias("n_quoted"),
        F.sum(F.when(F.col("_source").isNotNull(), F.col("_n")).otherwise(0)).alias("n_linked"),
        F.max(F.when(F.col("_source").isNotNull(), F.struct(-F.col("_depth"), F.col("_n"), F.col("_source")))).alias("_best"))
    linked = stored(counted.select("_conv", "_turn", "n_quoted", "n_linked", F.col("_best._source").alias("reply_to")), "linked")
    paths = reply_paths(linked)
    narrow = messages.select(*others(messages, *OUTPUTS, "_conv", "_turn"), *key)
    out = narrow.join(paths, ["_conv", "_turn"], "left")
    own = F.coalesce(F.col("path"), F.array(F.col("_turn")))
    kept = [F.col(f"`{c}`") for c in narrow.columns if c not in ("_conv", "_turn")]
    said_clean = clean(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return out.select(
        *kept, said_clean.alias("clean_text"),
        F.concat(F.coalesce(F.col(f"`{role}`"), F.lit("unknown")), F.lit(": "), said_clean).alias("formatted"),
        F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"), F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        F.col("reply_to"), F.element_at(own, 1).alias("root"), (F.size(own) - 1).alias("depth"), own.alias("path"))


def clean(text: Column) -> Column:
    """Lines that aren't quoted; blank lines at the ends go."""
    kept = F.filter(lines(text), lambda x: x["depth"] == 0)
    return F.when(F.rlike(text, F.lit("(?m)" + MARKS)), F.trim(F.array_join(F.transform(kept, lambda x: x["body"]), "\n"))).otherwise(text)


def reply_paths(linked: DataFrame) -> DataFrame:
    """`linked` with the turns from the first message of a thread to each message that quotes.

    A round joins each unfinished path to the path of its first message, so a round doubles what is known.
    """
    paths = linked.withColumn("path", F.when(F.col("reply_to").isNotNull(), F.array("reply_to", "_turn")).otherwise(F.array("_turn")))
    for _ in range(MOST_ROUNDS):
        heads = paths.filter(F.size("path") > 1).select(F.col("_conv").alias("c"), F.col("_turn").alias("t"), F.col("path").alias("before"))
        head = F.element_at(F.col("path"), 1)
        joined = paths.join(heads, (F.col("_conv") == F.col("c")) & (head == F.col("t")) & (F.size("path") > 1), "left")
        paths = stored(joined.select(
            *linked.columns, F.when(F.col("before").isNotNull(), F.concat("before", F.slice("path", 2, F.size("path")))).otherwise(F.col("path")).alias("path"),
            F.col("before").isNotNull().alias("_grew")), "paths")
        if paths.filter("_grew").isEmpty():
            break
        paths = paths.drop("_grew")
    else:
        raise RuntimeError(f"reply paths are not complete after {MOST_ROUNDS} rounds")
    return paths.drop("_grew")
