"""Quotation linking: quoted passages name the message a reply answers.

Lines are read by their quote marks (``>``, ``>>``, ``> >``).  Lines of one level that
stand together are a passage; a passage and each of its lines are normalised (lower
case, single blanks) and hashed.  Unquoted passages and lines of the same conversation,
reduced to the first turn that has them, are the originals.  A reply's parent is the
earlier turn that most quoted lines of its shallowest resolved level come from, the
earlier of two equals.  Roots and depths follow from doubling steps over parent links,
and messages are laid out thread by thread in reply order, without their quotes.

Column expressions, grouped sums and joins only.  Conversations without any quote take
no part in the linking; hot conversations spread, since keys hold the passage hash, and
numbering cuts groups freely.

Edge cases: a NULL text has no lines and keeps NULL; an empty one stays empty.  Messages
without conversation or turn are roots of their own and answer nothing.  Messages that
share a turn share parent, root and depth; repeated rows stay.  A passage that no earlier turn
has links nothing.  An empty table gives an empty result; input columns named like a
result column are replaced, others are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ordering import row_numbers
from tallyframe.session import State, materialize

QUOTE = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"^On .{1,200} wrote:[ \t\r]*$"
RESULT = ["quote_levels", "quoted_lines", "own_text", "parent_turn", "root_turn", "depth", "position"]


def is_quote(line):
    return line.rlike(QUOTE)


def own_text(text, quoted):
    """The lines that are not quotes, without lines that announce one."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~is_quote(x) & ~x.rlike(ATTRIBUTION))
    return F.when(quoted, F.trim(F.array_join(lines, "\n"))).otherwise(text)


def units(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, hash, weight): passages and their lines, by quote level."""
    line = messages.select("conv", "turn", F.xxhash64("text").alias("__t"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    level = F.length(F.regexp_replace(F.regexp_extract("line", QUOTE, 0), "[^>]", ""))
    body = F.trim(F.lower(F.regexp_replace(F.regexp_replace("line", QUOTE, ""), r"\s+", " ")))
    line = line.select("conv", "turn", "__t", "at", level.alias("level"), body.alias("body"))
    # a break in level or an empty line ends a passage
    line = line.withColumn("kind", F.when(F.col("body") == "", -1).otherwise(F.col("level")))
    message = ["conv", "turn", "__t"]
    place = F.row_number().over(Window.partitionBy(*message).orderBy("at"))
    within = F.row_number().over(Window.partitionBy(*message, "kind").orderBy("at"))
    line = line.withColumn("run", place - within).where("kind >= 0")
    passage = line.groupBy(*message, "level", "run").agg(
        F.sort_array(F.collect_list(F.struct("at", "body"))).alias("rows")).where(F.size("rows") > 1)
    whole = F.array_join(F.transform("rows", lambda x: x["body"]), " ")
    passage = passage.select("conv", "turn", "level", F.md5(whole).alias("hash"), F.size("rows").alias("weight"))
    return line.select("conv", "turn", "level", F.md5("body").alias("hash"), F.lit(1).alias("weight")).unionByName(passage)


def parents(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent) from rows (conv, turn, text) with none of them NULL."""
    quoting = messages.where(F.exists(F.split("text", "\n"), is_quote))
    some = quoting.select("conv").distinct().withColumn("__q", F.lit(True))
    parts = materialize(units(State(some, ["conv"]).attach(messages, "inner").drop("__q")))
    original = parts.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("source"))
    quoted = parts.where("level > 0").groupBy("conv", "turn", "level", "hash").agg(F.sum("weight").alias("weight"))
    found = State(original, ["conv", "hash"], stored=True).attach(quoted, "inner").where("source < turn")
    votes = found.groupBy("conv", "turn", "level", "source").agg(F.sum("weight").alias("votes"))
    best = F.min(F.struct("level", (-F.col("votes")).alias("less"), "source"))
    return votes.groupBy("conv", "turn").agg(best.alias("b")).select("conv", "turn", F.col("b.source").alias("parent"))


def roots(links: DataFrame) -> DataFrame:
    """(conv, turn, parent, root, depth) of every turn that answers another.  Each step
    doubles the distance looked up, so a chain of n replies takes log n steps."""
    at = links.select("conv", "turn", "parent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    while True:
        at = materialize(at)
        up = at.select("conv", F.col("turn").alias("root"), F.col("root").alias("far"), F.col("depth").alias("more"))
        # an ancestor that is no root itself moves the pointer on
        moved = State(up, ["conv", "root"], stored=True).attach(at)
        if not moved.where("far IS NOT NULL").limit(1).count():
            return at
        at = moved.select("conv", "turn", "parent", F.coalesce("far", "root").alias("root"),
                          (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """messages with RESULT; ``position`` numbers the messages of a conversation thread by
    thread, each thread in turn order, so that a reply follows what it answers."""
    kept = [c for c in messages.columns if c.lower() not in RESULT]
    rows = messages.select(*[F.col(f"`{c}`") for c in kept])
    t = F.col(text).cast("string")
    lines = F.split(F.coalesce(t, F.lit("")), "\n")
    quoted = F.filter(lines, is_quote)
    level = F.transform(quoted, lambda x: F.length(F.regexp_replace(F.regexp_extract(x, QUOTE, 0), "[^>]", "")))
    rows = rows.withColumn("quoted_lines", F.size(quoted)).withColumn("quote_levels", F.coalesce(F.array_max(level), F.lit(0)))
    rows = rows.withColumn("own_text", own_text(t, F.col("quoted_lines") > 0))
    named = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), t.alias("text")).dropna()
    links = materialize(parents(named))
    if links.limit(1).count():
        tree = roots(links).select(F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("parent").alias("parent_turn"), F.col("root").alias("root_turn"), "depth")
        rows = State(tree, [conv, turn], stored=True).attach(rows)
    else:
        kind = dict(messages.dtypes)[turn]
        rows = rows.withColumns({"parent_turn": F.lit(None).cast(kind), "root_turn": F.lit(None).cast(kind), "depth": F.lit(None).cast("long")})
    rows = rows.withColumn("root_turn", F.coalesce("root_turn", turn)).withColumn("depth", F.coalesce("depth", F.lit(0)))
    # ties of a turn are put in an order that does not depend on where rows lie
    rows = rows.withColumn("__tie", F.xxhash64(*kept))
    return row_numbers(rows, ["root_turn", turn, "__tie"], "position", [conv]).select(*kept, *RESULT)
