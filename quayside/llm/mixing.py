"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.shared import free, small_enough, stored


def tokens(text: str) -> Column:
    """The number of words that white space separates; zero for a NULL text."""
    parts = F.array_remove(F.split(F.col(text), r"\s+"), "")
    return F.coalesce(F.size(parts), F.lit(0)).cast("long")


def category(column: str) -> Column:
    """A category as text that is never NULL; a NULL is a category of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares of a dimension: its token shares to a power, so that below 1 the small categories gain."""
    shares = cells.groupBy(dimension).agg((F.sum("tokens").cast("double") ** power).alias("raised")).where("raised > 0")
    total = shares.agg(F.sum("raised").alias("all"))
    return shares.join(F.broadcast(total)).select(dimension, (F.col("raised") / F.col("all")).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float, most_rounds: int | None = None) -> tuple[DataFrame, float]:
    """``cells`` with ``factor``, the product of a factor per dimension, and how much the last round moved them.

    A round finds, for each dimension in turn, the factors by which its token shares meet the targets, given
    the others' factors. Rounds go on until no factor moves by more than ``tolerance`` of its value, or until the
    largest move has not fallen for three rounds, as where missing cells let no weights meet all targets (or until
    ``most_rounds``, if given). A category without a target gets factor zero. Cells are counts, and each step one grouping of them, with the factors so far in a
    stored table per dimension; the driver sees the largest move only.
    """
    total = cells.agg(F.sum("tokens").cast("double").alias("all"))
    shares = stored(cells.join(F.broadcast(total)).withColumn("now", F.col("tokens") / F.col("all")), "shares")
    factors = {d: target.select(d, F.lit(1.0).alias(f"f_{d}")) for d, target in targets.items()}
    worst, rounds = float("inf"), 0
    least, stale = worst, 0
    while worst > tolerance and stale < 3 and (most_rounds is None or rounds < most_rounds):
        worst, rounds = 0.0, rounds + 1
        for dimension, target in targets.items():
            weighted = shares
            for other in targets:
                if other != dimension:
                    weighted = weighted.join(factors[other], other)
            now = reduce(lambda x, y: x * y, [F.col(f"f_{other}") for other in targets if other != dimension], F.col("now"))
            sums = weighted.groupBy(dimension).agg(F.sum(now).alias("sum")).where("sum > 0")
            new = target.join(sums, dimension, "left").join(factors[dimension].withColumnRenamed(f"f_{dimension}", "was"), dimension)
            value = F.coalesce(F.col("share") / F.col("sum"), F.lit(0.0))
            new = stored(new.select(dimension, value.alias(f"f_{dimension}"), F.abs(value / F.nullif(F.col("was"), F.lit(0.0)) - 1).alias("move")), "factors")
            worst = max(worst, new.agg(F.max("move")).first()[0] or 0.0)
            factors[dimension] = new.drop("move")
        stale = 0 if worst < least * (1 - 1e-6) else stale + 1
        least = min(least, worst)
    for dimension in targets:
        cells = cells.join(factors[dimension], dimension, "left").fillna(0.0, [f"f_{dimension}"])
    product = reduce(lambda x, y: x * y, [F.col(f"f_{d}") for d in targets])
    return stored(cells.withColumn("factor", product).select(*targets, "tokens", "factor"), "raked"), worst


def mix(
    docs: DataFrame, dimensions: dict[str, float], targets: dict[str, DataFrame] | None = None, seed: int = 0,
    tolerance: float = 1e-3, most_rounds: int | None = None, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` with ``tokens``, ``probability``, ``sampled`` and ``residual``.

    ``dimensions`` names the columns whose token shares are raked, each with the power that tempers its present
    shares into the target ones; ``targets`` may give a dimension's shares instead (the category as in
    ``category`` and ``share``). A document's probability is the factor of its cell over the largest factor, so
    none exceeds one, the cell scarcest against its targets is kept whole, and the expected token shares meet
    the targets. ``residual``, the same for all rows, is the largest part by which the last round still moved a
    factor: above ``tolerance``, which is warned of too, the shares miss the targets. A document is sampled if a number between 0 and 1 that follows from ``seed``, id and text is
    below that: a rerun samples the same documents, and repeated rows agree.

    A NULL category counts as one of its own. A NULL or empty text has no tokens, moves no share and has the
    probability of its cell (zero if the cell has no token). NULL ids take part. An empty table gives no rows.
    Other columns stay; those named as the result's are replaced. The counts by cell are worked out
    before any shuffle, so a hot source is a row per task.
    """
    names = list(dimensions)
    marked = docs.withColumn("tokens", tokens(text))
    keys = [category(d).alias(f"d{i}") for i, d in enumerate(names)]
    cells = stored(marked.groupBy(*keys).agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "cells")
    given = targets or {}
    wanted = {f"d{i}": given[d].toDF(f"d{i}", "share") if d in given else stored(tempered(cells, f"d{i}", dimensions[d]), "target") for i, d in enumerate(names)}
    raked, residual = rake(cells, wanted, tolerance, most_rounds)
    if residual > tolerance:
        warnings.warn(f"token shares miss their targets: the last round still moved a factor by {residual:.3g} of its value", stacklevel=2)
    top = raked.agg(F.max("factor").alias("top"))
    chances = raked.join(F.broadcast(top)).select(*wanted, (F.col("factor") / F.col("top")).alias("chance"))
    mine = {c: free(marked, c) for c in (*wanted, "chance")}
    chances = stored(chances.select(*[F.col(c).alias(name) for c, name in mine.items()]), "chances")
    on = reduce(lambda a, b: a & b, [category(d) == F.col(mine[f"d{i}"]) for i, d in enumerate(names)])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.xxhash64(id, text)), 11) / F.lit(float(1 << 53))
    out = marked.join(chances, on, "left")
    chance = F.coalesce(mine["chance"], F.lit(0.0))
    return out.withColumns({"probability": chance, "sampled": draw < chance, "residual": F.lit(float(residual))}).drop(*(set(mine.values()) - set(names)))


def with_topic(docs: DataFrame, embeddings: DataFrame) -> DataFrame:
    """``docs`` with ``topic``: the label of the document's vector, NULL without one; the least of several."""
    _vec, _label = free(docs, "vec"), free(docs, "label")
    labels = embeddings.where("vec_id IS NOT NULL").groupBy(F.col("vec_id").alias(_vec)).agg(F.min("label").alias(_label))
    labels = small_enough(stored(labels, "labels"))
    return docs.join(labels, docs["doc_id"] == labels[_vec], "left").withColumn("topic", F.col(_label)).drop(_vec, _label)


def sample_shares(rows: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Token shares before and after sampling by dimension and category: a report on ``mix``'s result."""
    parts = [
        rows.groupBy(F.lit(d).alias("dimension"), category(d).alias("category")).agg(
            F.sum("tokens").alias("tokens"), F.sum(F.when(F.col("sampled"), F.col("tokens")).otherwise(0)).alias("sampled_tokens")
        )
        for d in dimensions
    ]
    return reduce(DataFrame.union, parts)
