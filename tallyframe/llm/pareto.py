"""Mixing sources to target weights by Pareto order sampling.

Sources share all words by weight; a source takes at most CAP times its own words, and
what is above goes to the others by weight until none is above (a water level, found in
rounds of one sum over the sources).  A document then has an expected number of copies:
the whole part of it is certain, the rest is its inclusion odds for one more copy.
Documents are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)),
and the first of them are taken until the source's missing words are reached: the size
of the sample is fixed in words.  Where the next document is too long for the words
still missing, later rounds go on down the ranking with documents that fit.

No source is sorted.  A rank becomes a number of BITS * LEVELS bits; words are summed by
(source, first bits), which finds the bin in which the words run out, and only that bin
is looked into by further bits, until it holds FEW rows, which are ranked.  A source with
a third of all rows is summed where its rows lie.  Per source one row of state is kept,
broadcast when small and joined otherwise.

u is a hash of seed, key and size, so reruns and other partitionings agree.

Edge cases: NULL texts and texts without words have size 0 and are taken as 0.  A NULL
source is a source, the last one.  A source without words has target 0.  Rows that repeat
key, size and source share their rank, and are taken together or not at all.  NULL and
negative merits count as 0, and words that merits and the cap leave no room for stay
missing.  An empty table gives no rows.  Extra columns are not read unless kept by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators import ordering
from tallyframe.session import State, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
BITS, LEVELS = 10, 5
FEW = 1_000
ROUNDS = 4


def slim(state: State, *columns: str) -> State:
    """The state with some of its columns."""
    out = copy(state)
    out.df = state.df.select(*state.keys, *columns)
    return out


def share_out(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """sources (size and weight as __size, __weight) with __target: all words by weight,
    none above cap times its own."""
    most, level = F.lit(cap).cast("long") * F.col("__size"), 0.0
    total = sources.agg(F.sum("__size")).first()[0] or 0
    full = F.lit(False)
    while True:
        r = sources.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("__weight")))).first()
        new = (total - (r[0] or 0)) / r[1] if r[1] else level
        if new == level:
            break
        level = new
        full = F.col("__weight") * F.lit(level) > most
    return sources.withColumn("__target", F.when(full, most.cast("double")).otherwise(F.col("__weight") * F.lit(level)))


def expected_copies(rows: DataFrame, sources: State, cap: int) -> tuple[State, Column]:
    """Per source the factor that turns merits into copies, none above cap, whose words
    add up to the target; and the copies as a column over rows with the factor."""
    room = F.coalesce(F.try_divide("__target", "__words"), F.lit(0.0))
    state = State(sources.df.withColumn("__factor", room), ["__source"])
    copies = F.least(F.col("__factor") * F.col("__merit"), F.lit(float(cap)))
    while True:
        full = F.col("__factor") * F.col("__merit") >= cap
        got = state.attach(rows).groupBy("__source").agg(
            F.sum(F.when(full, F.col("__size") * cap)).alias("__full"),
            F.sum(F.when(~full, F.col("__size") * F.col("__merit"))).alias("__rest"))
        got = got.select(F.col("__source").alias("__s"), "__full", "__rest")
        new = state.df.join(got, F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s")
        left = F.col("__target") - F.coalesce(F.col("__full"), F.lit(0).cast("long"))
        factor = F.when(F.col("__rest") > 0, F.greatest(left / F.col("__rest"), F.col("__factor"))).otherwise(F.col("__factor"))
        new = State(new.withColumn("__new", factor), ["__source"])
        moved = new.df.where("__new > __factor * (1 + 1e-12)").limit(1).count()
        state = State(new.df.withColumn("__factor", F.col("__new")).drop("__new", "__full", "__rest"), ["__source"])
        if not moved:
            return state, copies


def edge(rows: DataFrame) -> DataFrame:
    """Per source of rows (__source, __size, __k, __left): the last rank __mark up to which
    the words fit into __left, and these words as __got."""
    inside = rows.withColumn("__used", F.lit(0).cast("long"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        sums = inside.groupBy("__source", "__left", "__used", F.shiftright("__k", shift).alias("__b")).agg(
            F.sum("__size").alias("__w"), F.count("*").alias("__n"))
        upto = F.col("__used") + F.sum("__w").over(Window.partitionBy("__source").orderBy("__b"))
        sums = sums.withColumn("__upto", upto)
        over = F.col("__upto") > F.col("__left")
        found = sums.groupBy("__source").agg(
            F.min(F.when(over, F.struct("__b", "__n"))).alias("__x"),
            F.max(F.when(~over, F.col("__upto"))).alias("__fit"), F.max("__used").alias("__before"))
        bottom = F.shiftleft(F.col("__x.__b"), shift)
        if not level:  # all words of a source may fit; a bin that overflows has a bin that does
            bottom = F.coalesce(bottom, F.lit(1 << (BITS * LEVELS)).cast("long"))
        found = found.select("__source", bottom.alias("__bottom"), F.col("__x.__n").alias("__n"),
                             F.coalesce("__fit", "__before").alias("__used"))
        if level:
            old = state.df.select(F.col("__source").alias("__s"), F.col("__bottom").alias("__old"), F.col("__used").alias("__u"))
            found = old.join(found, F.col("__s").eqNullSafe(F.col("__source")), "left").select(
                F.col("__s").alias("__source"), F.coalesce("__bottom", "__old").alias("__bottom"), "__n", F.coalesce("__used", "__u").alias("__used"))
        state = State(found, ["__source"])
        most = state.df.agg(F.max("__n")).first()[0] or 0
        marks = state.df.select("__source", (F.col("__bottom") - 1).alias("__mark"), F.col("__used").alias("__got"))
        if not most or not shift:
            return marks
        inside = state.attach(rows).where(F.col("__n").isNotNull() & (F.shiftright("__k", shift) == F.shiftright("__bottom", shift)))
        inside = inside.drop("__bottom", "__n")
        if most <= FEW:
            break
    last = Window.partitionBy("__source").orderBy("__k").rangeBetween(Window.unboundedPreceding, 0)
    fits = inside.withColumn("__upto", F.col("__used") + F.sum("__size").over(last)).where("__upto <= __left")
    fits = fits.groupBy(F.col("__source").alias("__s")).agg(F.max("__k").alias("__last"), F.max("__upto").alias("__fit"))
    return marks.join(fits, F.col("__source").eqNullSafe(F.col("__s")), "left").select(
        "__source", F.coalesce("__last", "__mark").alias("__mark"), F.coalesce("__fit", "__got").alias("__got"))


def chosen() -> Column:
    """Whether a row gets one more copy: some round's rank reaches it and it fitted then."""
    return F.exists(F.col("__rounds"), lambda r: (F.col("__size") <= r["room"]) & (F.col("__k") <= r["mark"]))


def sample(rows: DataFrame, sources: State, rounds: int = ROUNDS) -> State:
    """sources with what each round took: the words missing before it and its last rank."""
    empty = F.array().cast("array<struct<room: double, mark: bigint>>")
    state = State(sources.df.withColumn("__rounds", empty), ["__source"])
    for _ in range(rounds):
        fitting = state.attach(rows.where("__k IS NOT NULL")).where((F.col("__size") <= F.col("__left")) & ~chosen())
        got = edge(fitting.select("__source", "__size", "__k", "__left"))
        got = got.select(F.col("__source").alias("__s"), "__mark", "__got").where("__got > 0")
        new = state.df.join(got, F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s")
        step = F.array(F.struct(F.col("__left").alias("room"), F.col("__mark").alias("mark")))
        new = new.withColumn("__rounds", F.when(F.col("__mark").isNotNull(), F.concat("__rounds", step)).otherwise(F.col("__rounds")))
        new = new.withColumn("__left", F.col("__left") - F.coalesce(F.col("__got"), F.lit(0).cast("long")))
        state = State(new.drop("__mark"), ["__source"])
        more = state.df.where("__got > 0").limit(1).count()
        state = slim(state, "__left", "__rounds")
        if not more:
            break
    return state


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", by: str = "source", weights: Sequence[int] = WEIGHTS,
        cap: int = CAP, merit: Column | None = None, seed: str = "mix", keep: Sequence[str] = ()) -> DataFrame:
    """(key, size, source_size, target, taken, copies, kept columns) for each row of docs.

    ``weights`` go to the sources in order of their names, again and again.  Expected
    copies are equal within a source, or in proportion to ``merit``.
    """
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(
        F.col(f"`{key}`").alias("__key"), F.col(f"`{by}`").alias("__source"), words.alias("__size"),
        F.greatest(F.coalesce((F.lit(1.0) if merit is None else merit).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("__merit"),
        *[F.col(f"`{c}`").alias(f"__keep_{n}") for n, c in enumerate(keep)])
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("__key").cast("string"), F.col("__size").cast("string"))), 1, 13), 16, 10)
    rows = materialize(rows.withColumn("__u", (draw.cast("long") + F.lit(0.5)) / F.lit(float(2**52))))

    sums = rows.groupBy("__source").agg(F.sum("__size").alias("__size"), F.sum(F.col("__size") * F.col("__merit")).alias("__words"))
    order = ordering.row_numbers(sums, [F.col("__source").asc_nulls_last()], "__at")
    nth = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(F.col("__at") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = materialize(order.withColumn("__weight", nth).drop("__at"))
    sources = share_out(sources, cap).withColumnRenamed("__size", "__all")
    state = State(sources, ["__source"])
    if merit is None:
        state = State(state.df.withColumn("__factor", F.coalesce(F.try_divide("__target", "__all"), F.lit(0.0))), ["__source"])
        copies = F.col("__factor")
    else:
        state, copies = expected_copies(rows, state, cap)

    odds = F.col("__copies") - F.col("__whole")
    rank = (F.col("__u") / (1 - F.col("__u"))) / (odds / (1 - odds))
    top = F.lit((1 << (BITS * LEVELS)) - 1).cast("long")
    scaled = F.least(F.floor(rank / (1 + rank) * F.lit(float(1 << (BITS * LEVELS)))).cast("long"), top)

    def ranked(s: State) -> DataFrame:
        df = s.attach(rows).withColumn("__copies", copies).withColumn("__whole", F.floor("__copies").cast("long"))
        return df.withColumn("__k", F.when((odds > 0) & (F.col("__size") > 0), scaled))

    plain = slim(state, "__factor")
    certain = ranked(plain).groupBy("__source").agg(F.sum(F.col("__whole") * F.col("__size")).alias("__certain"))
    left = state.df.join(certain.withColumnRenamed("__source", "__s"), F.col("__source").eqNullSafe(F.col("__s")), "left")
    left = State(left.select("__source", (F.col("__target") - F.col("__certain")).alias("__left")), ["__source"])
    rounds = sample(ranked(plain).select("__source", "__size", "__k"), left)
    fields = state.df.join(rounds.df.select(F.col("__source").alias("__s"), "__rounds"), F.col("__source").eqNullSafe(F.col("__s")), "left")
    out = ranked(State(fields.select("__source", "__all", "__target", "__factor", "__rounds"), ["__source"]))
    n = F.col("__whole") + F.coalesce(chosen(), F.lit(False)).cast("long")
    return out.withColumn("__n", n).select(
        F.col("__key").alias(key), F.col("__size").alias("size"), F.col("__all").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__n") * F.col("__size")).alias("taken"), F.col("__n").alias("copies"),
        *[F.col(f"__keep_{n}").alias(c) for n, c in enumerate(keep)])


def expand(mixed: DataFrame, copies: str = "copies", name: str = "copy") -> DataFrame:
    """One row for each copy that the mix takes, numbered from 1."""
    return mixed.where(F.col(copies) > 0).withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
