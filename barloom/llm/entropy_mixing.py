"""Mixing sources to target weights by entropy balancing.

Every source has a target number of words. Among all document rates between 0 and `cap` whose
expected words meet the target, the balanced ones are closest to 1 in relative entropy: rates
min(cap, exp(t * size)), with one tilt t a source. The tilts solve a convex dual, by Newton steps
that are kept in brackets. Rates depend on source and size only, so the steps run over a table of
counts by (source, size), gathered once, instead of the documents.

Rates become copies by systematic rounding along each source, sorted by size: document i gets
floor(c + r_i) - floor(c) copies, c being half plus the sum of the rates before it. Errors of
neighbours cancel, so a source's words miss the target by no more than about its largest size.

All of it is DataFrame functions; nothing of the documents or sources reaches the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import free_names, ranked, word_count
from barloom.work import written


@dataclass(frozen=True)
class Settings:
    #: Weights of the sources in code point order, null last, repeating.
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    #: All targets together, as a multiple of all words.
    share: float = 1.5
    #: No document, and so no source, is taken more often than this.
    cap: float = 2.0
    max_steps: int = 100
    tolerance: float = 1e-7


SETTINGS = Settings()


def targets(sources: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """(source, source_size, target) from written (source, source_size).

    Targets share `share` of all words by weight. A target above `cap` times its source stops
    there, and the excess is shared anew among the others, until none is above.
    """
    weight = F.array(*map(F.lit, settings.weights))[
        (F.col("rank") % len(settings.weights)).cast("int")]
    now = ranked(sources, F.col("source").asc_nulls_last()).select(
        "source", "source_size", weight.alias("weight"),
        (settings.cap * F.col("source_size")).alias("most"))
    now = written(now, "weighted")
    total = settings.share * (now.agg(F.sum("source_size")).first()[0] or 0)

    def above(level: float) -> Column:
        return level * F.col("weight") >= F.col("most")

    # The common level of target over weight; every source that reaches its cap raises it.
    level, capped = 0.0, -1
    while True:
        full = above(level) if level else F.lit(False)
        got = now.agg(
            F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight"))),
            F.count_if(full)).first()
        if got[2] == capped or not got[1]:
            break
        level, capped = max(level, (total - (got[0] or 0)) / got[1]), got[2]
    return now.select("source", "source_size", F.least(level * F.col("weight"), "most").alias("target"))


def exact_sum(x: Column) -> Column:
    """A sum in millionths, so that it doesn't depend on the order of the rows."""
    return F.sum(F.round(x * 1e6).cast("decimal(38,0)")).cast("double") / 1e6


def balanced(cells: DataFrame, wanted: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """(source, tilt, scale) of every source; rates are min(cap, exp(tilt * size / scale)).

    `cells` is written (source, size, n), `wanted` written (source, source_size, target). A source
    whose target is all it can give has a null tilt, which means a rate of `cap`; one of none but
    empty documents has tilt 0. Each Newton step is one pass over the cells and writes one row a
    source; a step that leaves its bracket is halved or doubled instead.
    """
    log_cap = math.log(settings.cap)
    n_docs = cells.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = wanted.join(n_docs, wanted["source"].eqNullSafe(n_docs["source"])).select(
        wanted["source"], "target", F.greatest("mean", F.lit(1e-9)).alias("scale"),
        F.when(F.col("source_size") == 0, 0.0)
        .when(F.col("target") < settings.cap * F.col("source_size") * (1 - 1e-12), 0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        ((F.col("source_size") == 0)
         | (F.col("target") >= settings.cap * F.col("source_size") * (1 - 1e-12))).alias("done"))
    state = written(state, "tilts")

    for _ in range(settings.max_steps):
        open_ = state.where("not done")
        if open_.isEmpty():
            break
        u = F.col("tilt") * F.col("size") / F.col("scale")
        rate = F.when(u < log_cap, F.exp(u)).otherwise(settings.cap)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(u < log_cap, words * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = (
            cells.join(open_, cells["source"].eqNullSafe(open_["source"]))
            .groupBy(open_["source"], "target", "scale", "tilt", "low", "high")
            .agg(exact_sum(words).alias("words"), exact_sum(slope).alias("slope")))
        short = F.col("words") < F.col("target")
        low = F.when(short, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(short, F.col("high")).otherwise(F.col("tilt"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") + (F.col("target") - F.col("words"))
                        / F.col("slope"))
        inside = newton.isNotNull() & (F.col("low").isNull() | (newton > F.col("low"))) & (
            F.col("high").isNull() | (newton < F.col("high")))
        wide = F.greatest(F.lit(1.0), F.abs("tilt"))
        bisected = (
            F.when(F.col("low").isNull(), F.col("tilt") - wide)
            .when(F.col("high").isNull(), F.col("tilt") + wide)
            .otherwise((F.col("low") + F.col("high")) / 2))
        near = F.abs(F.col("words") - F.col("target")) <= settings.tolerance * F.col("target")
        stuck = F.col("high") - F.col("low") <= 1e-12 * wide
        stepped = (
            sums.withColumn("low", low).withColumn("high", high)
            .withColumn("done", near | F.coalesce(stuck, F.lit(False)))
            # No step further than it takes to change the mean document's rate 50-fold.
            .withColumn("next", F.when(inside, newton).otherwise(bisected))
            .withColumn("next", F.greatest(F.col("tilt") - 4, F.least(F.col("tilt") + 4, "next")))
            .withColumn("tilt", F.when(F.col("done"), F.col("tilt")).otherwise(F.col("next"))))
        state = written(
            state.where("done").unionByName(stepped.select(*state.columns)), "tilts")
    else:
        raise RuntimeError(f"no balance after {settings.max_steps} steps")
    return state.select("source", "tilt", "scale")


def mix(docs: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """One row for each row of `docs`: doc_id, source, size, source_size, target, rate, copies, taken.

    `docs` needs doc_id, text and source. A size is the number of words, 0 for a null or empty text;
    null is a source like any other, the last. copies is 0 to `cap`, taken is copies * size. The
    same rows give the same result at every run; of rows alike in source, size and doc_id any may
    get the copy that rounding gives to one of them. An empty table gives an empty result.
    """
    sizes = written(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    return mixed(sizes, settings)


def mixed(sizes: DataFrame, settings: Settings = SETTINGS, ties: tuple[str, ...] = ()) -> DataFrame:
    """What `mix` returns, from written (doc_id, source, size), and the columns `ties` with it.

    Rows alike in source, size and doc_id are rounded in the order of `ties`.
    """
    cells = written(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = written(
        cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
        "sources")
    wanted = written(targets(sources, settings), "targets")
    tilts = balanced(cells, wanted, settings)

    # Rates of the cells, and the sum of all rates before each one in its source, by size.
    plan = wanted.join(tilts, wanted["source"].eqNullSafe(tilts["source"])).drop(tilts["source"])
    u = F.col("tilt") * F.col("size") / F.col("scale")
    rate = F.when(u < math.log(settings.cap), F.exp(u)).otherwise(settings.cap)
    earlier = Window.partitionBy("source").orderBy("size").rowsBetween(
        Window.unboundedPreceding, -1)
    rated = cells.join(plan, cells["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    rated = rated.withColumn("rate", rate).withColumn(
        "before", F.coalesce(F.sum(F.col("rate") * F.col("n")).over(earlier), F.lit(0.0)))

    placed = ranked(
        sizes, F.col("source").asc_nulls_last(), F.col("size"),
        F.xxhash64(F.lit(9), "doc_id"), F.col("doc_id"), *map(F.col, ties))
    first = placed.groupBy("source", "size").agg(F.min("rank").alias("first"))
    rated = rated.join(
        first, rated["source"].eqNullSafe(first["source"]) & (rated["size"] == first["size"])
    ).drop(first["source"]).drop(first["size"])
    rated = written(rated.select(
        "source", "size", "source_size", "target", "rate", "before", "first"), "rates")

    start = 0.5 + F.col("before") + F.col("rate") * (F.col("rank") - F.col("first"))
    copies = F.least(
        F.floor(start + F.col("rate")) - F.floor(start), F.lit(int(settings.cap)).cast("long"))
    return (
        placed.join(
            rated, placed["source"].eqNullSafe(rated["source"]) & (placed["size"] == rated["size"]))
        .drop(rated["source"]).drop(rated["size"])
        .withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken", *ties)
    )


def take_copies(docs: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """The rows of `docs`, unchanged, each as often as `mix` takes it.

    Documents without words are taken once, as they have no words to weigh. Every row has a key of
    its own, its place in a written copy of `docs`, so rows alike in doc_id, source and size are
    decided one by one, those with different texts in the order of the texts' hashes.
    """
    size, text_hash, row, copies, again = free_names(
        docs, "_size", "_hash", "_row", "_copies", "_again")
    keyed = written(
        docs.withColumn(size, word_count("text")).withColumn(text_hash, F.xxhash64("text"))
        .withColumn(row, F.monotonically_increasing_id()), "keyed")
    sizes = keyed.select(
        "doc_id", "source", F.col(size).alias("size"), F.col(text_hash).alias("_hash"),
        F.col(row).alias("_row"))
    decided = mixed(sizes, settings, ("_hash", "_row")).select(
        F.col("_row").alias(row),
        F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies").cast("int")).alias(copies))
    decided = written(decided.where(F.col(copies) > 0), "copies")
    joined = keyed.join(decided.hint("merge"), row).select(*docs.columns, copies)
    repeated = joined.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.drop(copies, again)
