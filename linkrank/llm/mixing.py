"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.llm.text import packed, unpacked, whole_text, word_count
from linkrank.plans.workspace import Workspace

# Weights of the sources, by code point, over and over; how often a document may be taken.
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
# Characters that speak against a text, and how much: a text of nothing else weighs 1 / 21.
SYMBOLS = "#*$%&|<>"
SYMBOL_COST = 20.0
# Rows of a source that share one step of the running sum.
STEP_ROWS = 1_000


def quality(text: Column) -> Column:
    """Weight of a document in the draw, in (0, 1]: fewer symbols weigh more."""
    length = F.length(text)
    symbols = length - F.length(F.translate(text, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(SYMBOL_COST) * symbols / F.greatest(length, F.lit(1)))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) that the id alone decides: 52 bits of an MD5."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def source_targets(sized: DataFrame) -> DataFrame:
    """``(source, source_size, target, epochs, budget)`` from ``(source, size)`` rows.

    Sources weigh 1, 2, 3 and so on by code point, null last. A target is the smaller of
    MOST_EPOCHS times the source's size and its weight times one level for all, which the
    sources that are not held back share: sorted by the level at which they are held back,
    the level is what is left over the weights that are left. The windows run over one row
    per source: the mix's configuration, not its data.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everyone = Window.partitionBy()
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = sources.select(
        "source",
        "source_size",
        (F.lit(MOST_EPOCHS) * F.col("source_size")).alias("cap"),
        F.element_at(
            F.array(*map(F.lit, WEIGHTS)),
            ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"),
        ).alias("weight"),
    )
    until = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everyone) - F.sum("cap").over(until) + F.col("cap")).alias(
            "rest"
        ),
        (F.sum("weight").over(everyone) - F.sum("weight").over(until) + F.col("weight")).alias(
            "weights"
        ),
    )
    # A source is held back if the level that its place in the order gives lies above its own.
    free = F.col("rest") * F.col("weight") <= F.col("cap") * F.col("weights")
    level = F.min(F.when(free, F.struct((-F.col("weights")).alias("w"), "rest"))).over(everyone)
    target = F.when(
        free, F.col("rest_all").cast("double") * F.col("weight") / F.col("weights_all")
    ).otherwise(F.col("cap").cast("double"))
    leveled = left.withColumn("level", level).select(
        "*",
        F.col("level.rest").alias("rest_all"),
        (-F.col("level.w")).alias("weights_all"),
    )
    named = leveled.select("source", "source_size", target.alias("target"))
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    return named.withColumn("epochs", epochs.cast("long")).withColumn(
        "budget", F.col("target") - F.col("epochs") * F.col("source_size")
    )


# Sources whose bounds may be broadcast: a few hundred bytes each.
BROADCAST_SOURCES = 10_000


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with what the draw looks at: size, key, and what breaks ties."""
    text = whole_text()
    key = -F.log(uniform(F.col("doc_id"), seed)) / quality(text)
    return docs.withColumns(
        {"__size": word_count(text), "__key": key, "__tie": F.md5(text), "__id": F.col("doc_id")}
    )


def draw_bounds(ws: Workspace, docs: DataFrame, seed: str) -> DataFrame:
    """``(source, source_size, target, epochs, last)``: ``last`` is the key of the last
    document that the draw of a source takes, null if it takes none.

    The running sum of sizes goes over steps of keys of equal chance, then over the rows of
    the one step in which the budget ends.
    """
    rows = ws.save(
        _sized(docs, seed).select(
            "source",
            F.col("__size").alias("size"),
            F.struct(
                F.col("__key").alias("key"), F.col("__id").alias("id"), F.col("__tie").alias("tie")
            ).alias("place"),
        ),
        "rows",
    )
    targets = ws.save(source_targets(rows), "targets")
    steps = max(1, rows.count() // STEP_ROWS)
    step = F.floor((F.lit(1.0) - F.exp(-F.col("place.key"))) * steps).cast("long")
    stepped = rows.withColumn("step", step)
    before = (
        Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    )
    budgets = targets.select(F.col("source").alias("s"), "budget")
    # Steps that begin inside the budget; of each source the last one may cross it.
    sums = (
        stepped.groupBy("source", "step")
        .agg(F.sum("size").alias("step_size"))
        .withColumn("before", F.coalesce(F.sum("step_size").over(before), F.lit(0)))
        .join(budgets, F.col("source").eqNullSafe(F.col("s")))
        .where(F.col("before") < F.col("budget"))
    )
    newest = ws.save(
        sums.groupBy("source")
        .agg(F.max(F.struct("step", "before", "budget")).alias("at"))
        .select(F.col("source").alias("s"), "at.*")
        .withColumnRenamed("step", "t"),
        "steps",
    )
    same = F.col("source").eqNullSafe(F.col("s"))
    inside = (
        Window.partitionBy("source")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    crossing = (
        stepped.join(newest, same & (F.col("step") == F.col("t")))
        .withColumn("used", F.col("before") + F.sum("size").over(inside))
        .where(F.col("used") - F.col("size") / 2 < F.col("budget"))
        .groupBy("source")
        .agg(F.max("place").alias("inside"))
    )
    # Where nothing of that step fits, the draw ends with the step before it.
    earlier = (
        stepped.join(newest, same & (F.col("step") < F.col("t")))
        .groupBy("source")
        .agg(F.max("place").alias("earlier"))
    )
    crossing, earlier = ws.save(crossing, "inside"), ws.save(earlier, "earlier")
    return ws.save(
        targets.alias("t")
        .join(crossing.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
        .join(earlier.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left")
        .select(
            F.col("t.source").alias("__source"),
            F.col("source_size").alias("__source_size"),
            F.col("target").alias("__target"),
            F.col("epochs").alias("__epochs"),
            F.coalesce("inside", "earlier").alias("__last"),
        ),
        "bounds",
    )


def _drawn(ws: Workspace, docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with all of the above and ``__copies``: how often the mix takes a row."""
    bounds = draw_bounds(ws, docs, seed)
    if bounds.count() <= BROADCAST_SOURCES:
        bounds = F.broadcast(bounds)
    here = F.struct(
        F.col("__key").alias("key"), F.col("__id").alias("id"), F.col("__tie").alias("tie")
    )
    drawn = F.coalesce(here <= F.col("__last"), F.lit(False)).cast("long")
    return (
        _sized(docs, seed)
        .join(bounds, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__copies", F.col("__epochs") + drawn)
    )


def mix_sources(ws: Workspace, docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``(doc_id, size, source, source_size, target, copies, taken)`` per document.

    ``taken`` is the number of words the mix takes of a document: its size once for each
    complete epoch of its source, and once more if the draw chooses it. The draw sorts a
    source's documents by exponential keys over quality weights and takes all whose middle
    lies inside what complete epochs leave of the target; so a source misses its target by
    at most half a document. Null texts have size 0, null is a source like any other.
    Repeated ids draw equal numbers and are ordered by text. Reruns agree. Extra columns are
    ignored.
    """
    rows = _drawn(ws, docs.select("doc_id", "text", "source"), seed)
    return rows.select(
        "doc_id",
        F.col("__size").alias("size"),
        "source",
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__copies").alias("copies"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


def mixed_documents(ws: Workspace, docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it."""
    names = ("doc_id", "text", "source")
    times = F.array_repeat(F.lit(1), F.col("__copies").cast("int"))
    drawn = _drawn(ws, packed(docs, *names), seed).withColumn("__time", F.explode(times))
    return unpacked(drawn, docs.columns, names)
