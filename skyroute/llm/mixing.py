"""Mixing sources to target weights by iterative proportional fitting, DataFrame operations only.

Token counts are summed per cell (one value of every dimension). Raking scales the
cells' token weights to each dimension's target shares in turn, ``rounds`` times and then
until no value's share is off its target by more than ``TOLERANCE`` of it. Targets that
the cells cannot meet together end the rounds once they stop coming closer, with a
warning; ``__residual`` states the largest relative error that is left (1: a value with
a target has no weight). A
document of a cell is kept by a uniform number that its id and the seed decide, with a
probability proportional to ``calibrated weight / cell tokens`` (nothing is repeated):

* with ``keep``, the share of all tokens to keep, it is ``min(1, factor * ratio)``, with the
  factor that meets this budget: cells at 1 stay whole, the others share what is left of
  the budget by their weights. A tiny cell then moves the others by its own tokens only.
  The kept tokens follow the weights in expectation, but for what cells at 1 lack; a
  budget above the tokens that have a target keeps all of those. ``__rate`` states the
  share kept in expectation.
* without it, the largest probability is 1: the kept tokens follow the targets in
  expectation, at whatever rate (``__rate``) the cell with the largest ratio allows.

A dimension's target is either a table (value, share) or, without one, its own token
shares raised to ``power`` below 1, which lifts rare values. Values missing from a given
table get share 0 and are not sampled; values without tokens cannot be raised.

Cases: null values of a dimension are a value of their own; null and empty texts have 0
tokens and the probability of their cell (1 in a cell without tokens); a null id draws
by the id ``null``; repeated rows share their draw; extra columns stay or are ignored as
stated; an empty table gives an empty result. Weights are rounded to 9 digits.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyroute.llm.common import hinted, stored

#: Largest relative error of a value's share at which raking may end.
TOLERANCE = 1e-4
#: Raking is given up if so many rounds took less than a hundredth off the error, or after MOST_ROUNDS.
PATIENCE, MOST_ROUNDS = 25, 2_000
SPACE = "[\\x09-\\x0D\\x20]+"


def n_tokens(text: Column) -> Column:
    """Number of words (maximal runs without ASCII white space); 0 for null."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(body == "", 0).otherwise(F.size(F.split(body, SPACE))).cast("long")


def topic(text: Column) -> Column:
    """A topic by what a text shows: table rows, licence lines, marked-up noise or contacts; else prose."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(t.contains(" | "), "table").when(t.contains("icense"), "licensed")
            .when(t.contains("%%%") | t.contains("###") | t.contains("$$$"), "markup")
            .when(t.contains("@"), "contact").otherwise("prose"))


def uniform(id_: Column, seed: int) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def errors(rows: DataFrame, dims: list[str]) -> tuple[float, float]:
    """Largest relative error of the shares that have weight, and the same with those that have a target only."""
    now = {d: F.sum("weight").over(Window.partitionBy(d)) for d in dims}
    off = [F.when(F.col(f"__target_{d}") > 0, F.abs(now[d] / F.col(f"__target_{d}") - 1)).otherwise(now[d]) for d in dims]
    reached = [F.when(now[d] > 0, o).otherwise(0.0) for d, o in zip(dims, off, strict=True)]
    worst = rows.select(F.greatest(*reached, F.lit(0.0)).alias("reached"), F.greatest(*off, F.lit(0.0)).alias("all"))
    return tuple(e or 0.0 for e in worst.agg(F.max("reached"), F.max("all")).first())


def relaxed(exponent: float, rate: float) -> float:
    """The next exponent of the scaling factors, from the present one and the error's factor a round.

    Over-relaxation: it leads to the same weights, in about the square root of the rounds that
    plain scaling (exponent 1) takes where dimensions are strongly correlated.
    """
    if rate >= 1:
        return 1 + (exponent - 1) / 2
    if rate <= exponent - 1:
        return exponent
    plain = min((rate + exponent - 1) ** 2 / (rate * exponent**2), 0.9999)
    return min(2 / (1 + (1 - plain) ** 0.5), 1.95)


def rake(cells: DataFrame, dims: list[str], power: float, rounds: int,
         targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``cells`` (dims, tokens) with ``weight``: token shares raked to the dimensions' target shares, and ``residual``.

    A cell's rows meet by one value of a dimension at a time; that is at most the number
    of combinations of the other dimensions' values, however many documents there are.
    Each round is written to the shared folder. From round ``rounds`` on, the driver reads
    the largest errors after each.
    """
    whole = cells.agg(F.sum("tokens")).first()[0] or 1
    rows = cells.withColumn("weight", F.col("tokens") / F.lit(float(whole)))
    for d in dims:
        if (given := (targets or {}).get(d)) is not None:
            value, share = given.columns[:2]
            total = given.agg(F.sum(share)).first()[0]
            table = given.select(F.col(value).alias("__value"), (F.col(share) / F.lit(total)).alias(f"__target_{d}"))
            rows = rows.join(table, F.col(d).eqNullSafe(F.col("__value")), "left").drop("__value").fillna(
                0.0, [f"__target_{d}"])
            continue
        raised = cells.groupBy(F.col(d).alias("__value")).agg(F.sum("tokens").alias("__tokens"))
        raised = raised.withColumn("__raised", F.pow(F.col("__tokens").cast("double"), F.lit(power)))
        total = raised.agg(F.sum("__raised")).first()[0] or 1.0
        table = raised.select("__value", (F.col("__raised") / F.lit(total)).alias(f"__target_{d}"))
        rows = rows.join(table, F.col(d).eqNullSafe(F.col("__value"))).drop("__value")
    rows = stored(rows, "cells")
    seen, exponent = [], 1.0
    for n in range(1, max(rounds, MOST_ROUNDS) + 1):
        for d in dims:
            now = F.sum("weight").over(Window.partitionBy(d))
            scaled = (F.col("weight") * F.col(f"__target_{d}") / now if exponent == 1 else
                      F.col("weight") * F.pow(F.col(f"__target_{d}") / now, F.lit(exponent)))
            rows = rows.withColumn("weight", F.when(now > 0, scaled).otherwise(0.0))
        rows = stored(rows, "cells")
        if n < rounds:
            continue
        reached, residual = errors(rows, dims)
        seen.append(reached)
        if reached <= TOLERANCE or (len(seen) > PATIENCE and min(seen[-PATIENCE:]) > 0.99 * min(seen[:-PATIENCE])):
            break
        if len(seen) % 5 == 1 and len(seen) > 1:
            exponent = relaxed(exponent, (seen[-1] / seen[-5]) ** 0.25)
    if residual > TOLERANCE:
        warnings.warn(f"mixing: shares are up to {residual:.2%} off their targets after {n} rounds", stacklevel=2)
    return rows.drop(*[f"__target_{d}" for d in dims]).withColumn("residual", F.lit(residual))


def budget_factor(raked: DataFrame, keep: float) -> float:
    """The factor with sum(min(tokens, factor * weight)) = keep * sum(tokens); infinite if cells have too few tokens.

    Newton's method from below: the sum is concave in the factor, so the factor only grows,
    each step fills at least one more cell, and the step that fills none is exact.
    """
    budget = keep * (raked.agg(F.sum("tokens")).first()[0] or 0)
    factor, step = 0.0, budget
    while step > factor * (1 + 1e-12):
        factor = step
        full = F.col("weight") * F.lit(factor) >= F.col("tokens")
        taken, left = raked.where("weight > 0").agg(
            F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not left:
            return float("inf")
        step = (budget - (taken or 0)) / left
    return factor


def probabilities(cells: DataFrame, dims: list[str], power: float, rounds: int,
                  targets: dict[str, DataFrame] | None = None, keep: float | None = None) -> DataFrame:
    """(dims, tokens, weight, residual, probability) of every cell, and the share of all tokens kept (rate)."""
    raked = rake(cells, dims, power, rounds, targets)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    if keep is None:
        top = raked.agg(F.max(ratio)).first()[0] or 1.0
        chance = F.round(F.coalesce(ratio / F.lit(top), F.lit(1.0)), 9)
    else:
        factor = F.lit(budget_factor(raked, keep))
        chance = F.coalesce(F.when(ratio > 0, F.least(ratio * factor, F.lit(1.0))).otherwise(ratio), F.lit(1.0))
    known = stored(raked.withColumn("probability", chance).withColumn("weight", F.round("weight", 9)), "probabilities")
    rate = known.agg(F.sum(F.col("tokens") * F.col("probability")) / F.sum("tokens")).first()[0]
    return known.withColumn("rate", F.lit(1.0 if rate is None else rate))


def mix(docs: DataFrame, dims: dict[str, Column], tokens: Column, id_col: str = "doc_id", power: float = 0.7,
        rounds: int = 12, seed: int = 1, targets: dict[str, DataFrame] | None = None,
        keep: float | None = None) -> DataFrame:
    """``docs`` with ``__``-prefixed columns: the dims, tokens, weight, probability, rate, residual, draw and sampled.

    Documents are only joined with their cell; cells are broadcast if their measured size
    allows it, else the join shuffles (adaptive execution splits large cells).
    """
    names = {f"__{d}": c for d, c in dims.items()}
    rows = docs.withColumns(names | {"__tokens": tokens})
    cells = stored(rows.groupBy(*names).agg(F.sum("__tokens").alias("tokens")), "cells")
    known = probabilities(cells, list(names), power, rounds, targets and {f"__{d}": t for d, t in targets.items()}, keep)
    size = known.agg(F.sum(sum((F.coalesce(F.octet_length(d), F.lit(0)) for d in names), F.lit(96)))).first()[0] or 0
    sides = known.select(*[F.col(d).alias(f"{d}__cell") for d in names], F.col("weight").alias("__weight"),
                         F.col("probability").alias("__probability"), F.col("rate").alias("__rate"),
                         F.col("residual").alias("__residual"))
    same = [F.col(d).eqNullSafe(F.col(f"{d}__cell")) for d in names]
    return (rows.join(hinted(sides, size, 1), same).drop(*[f"{d}__cell" for d in names])
            .withColumn("__draw", uniform(F.col(id_col), seed))
            .withColumn("__sampled", F.col("__draw") < F.col("__probability")))
