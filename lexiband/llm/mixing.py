"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed into cells, one for each combination of the dimensions (source,
language and topic, say), weighed by tokens. The cells' weights are raked: scaled along one
dimension after the other until the token shares of every dimension are the target shares,
to a thousandth of each; a warning is logged if that can't be had. A
document of a cell is then drawn with a probability, and no document is repeated. Which one
depends on what is to hold:

* With a budget, a share of all tokens, the expected tokens are the budget. Cells that would
  have to be repeated are kept whole, and the others raked to what remains of the shares.
  Shares that can't be reached without repeats are logged as a warning, and the budget is
  met with the other documents. This is the default for the tempered shares of the documents
  themselves (BUDGET).
* `exact`, the default for given targets, divides raked weight / tokens by its largest value:
  the targets hold in expectation, whatever that costs. How much is kept then depends on the
  scarcest cell, and one odd document can make it little.

The draw is a hash of the document's id, so it is the same in every run and on every retry.

DataFrame functions only. Cells are combined before the shuffle, so a hot source is a few
rows. Sums are joined back to cells rather than computed in a window, so that no task holds
all cells of a language. Documents meet their cell by a broadcast whose size is checked, or
else by a join that AQE splits.

Defined results: null is a value of a dimension like any other. A null or empty text has no
tokens; it weighs nothing and is drawn like the rest of its cell, with probability 0 if the
whole cell has no tokens. A value that is missing in its dimension's targets gets share 0.
Target values that no document has get nothing, and the others share what is left. Rows with
a null id are drawn by their text. Repeated rows are drawn alike.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiband.llm.common import BROADCAST_ROWS, kept, small, stored

# Sweeps are at least SWEEPS and go on until no share is further off its target than TOLERANCE
# of it. They end unfinished, with a warning, after MOST_SWEEPS or when they gain nothing more.
SWEEPS, MOST_SWEEPS, TOLERANCE, GAIN, DIGITS = 6, 200, 1e-3, 1e-4, 13
WORD = r"[^ \t\n\r\f\x0B]+"
# The share of all tokens that is kept by default, and how often cells may be found to keep whole.
BUDGET, ROUNDS = 0.6, 20

log = logging.getLogger(__name__)


def token_count(text: Column) -> Column:
    """Words parted by white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(doc_id: str, text: str, seed: str) -> Column:
    """A number from 0 to under 1 that depends on the id and the seed."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    digits = F.substring(F.md5(F.concat(key, F.lit(":" + seed)).cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**DIGITS)


def cells(docs: DataFrame, dims: Mapping[str, Column], text: str) -> DataFrame:
    """d0, d1, ... and the tokens of each combination. The values are never null: a prefix
    tells a null from every string."""
    keys = dimension_keys(dims)
    return docs.select(*keys, token_count(F.col(text)).alias("tokens")).groupBy(*key_names(dims)).agg(
        F.sum("tokens").alias("tokens")
    )


def key_names(dims: Mapping[str, Column]) -> list[str]:
    return [f"d{i}" for i in range(len(dims))]


def dimension_keys(dims: Mapping[str, Column]) -> list[Column]:
    """A value with `=` before it, or the empty string for null."""
    return [
        F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("")).alias(f"d{i}")
        for i, value in enumerate(dims.values())
    ]


def tempered(cells_: DataFrame, key: str, alpha: float) -> DataFrame:
    """Target shares of one dimension: its token shares to the power `alpha`, to sum 1."""
    sums = cells_.groupBy(key).agg(F.sum("tokens").alias("tokens"))
    raised = sums.select(key, F.pow(F.col("tokens").cast("double"), F.lit(alpha)).alias("raised"))
    total = raised.agg(F.sum("raised")).scalar()
    return raised.select(key, F.when(total > 0, F.col("raised") / total).otherwise(0.0).alias("share"))


def rake(cells_: DataFrame, targets: Sequence[DataFrame], sweeps: int | None = None) -> DataFrame:
    """The cells with `weight`, whose shares along every dimension are the targets.

    `targets` has a table (key, share) for each dimension. `sweeps` sets a number of sweeps
    instead of the tolerance.
    """
    names = [f"d{i}" for i in range(len(targets))]
    return raked_with_shares(cells_, targets, sweeps).select(*names, "tokens", "weight")


def raked_with_shares(cells_: DataFrame, targets: Sequence[DataFrame], sweeps: int | None = None) -> DataFrame:
    """The raked cells, with the share of each dimension's value as share_d0, share_d1, ...

    The lineage is cut after every scaling, as each one reads the cells twice.
    """
    raked = cells_.withColumn("weight", F.col("tokens").cast("double"))
    names = [f"d{i}" for i in range(len(targets))]
    for key, target in zip(names, targets):
        raked = raked.join(target.withColumnRenamed("share", f"share_{key}"), key, "left")
    raked = kept(raked.na.fill(0.0, [f"share_{key}" for key in names]))
    few = raked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # and so are the sums of the cells
    done, last = 0, float("inf")
    while done != sweeps:
        for key in names:
            sums = raked.groupBy(key).agg(F.sum("weight").alias("held"))
            scaled = F.col("weight") * F.col(f"share_{key}") / F.col("held")
            weight = F.when(F.col("held") > 0, scaled).otherwise(0.0)
            raked = kept(raked.join(F.broadcast(sums) if few else sums, key).withColumn("weight", weight).drop("held"))
        done += 1
        if sweeps is None and done >= SWEEPS:
            off = largest_difference(raked, names)
            if off <= TOLERANCE:
                break
            if done >= MOST_SWEEPS or off > last * (1 - GAIN):
                log.warning("raking ended after %d sweeps with a share %.3g of its target off", done, off)
                break
            last = off
    return raked


def shares_held(cells_: DataFrame, names: Sequence[str], amount: Column) -> DataFrame:
    """dimension, value, the `share` it is to have and the one it has `reached`, for every value
    with tokens. The shares of values without tokens go to the others."""
    tables = []
    for key in names:
        sums = cells_.groupBy(key).agg(
            F.first(f"share_{key}").alias("share"), F.sum(amount).alias("held"), F.sum("tokens").alias("tokens")
        ).where("tokens > 0")
        shares, all_held = sums.agg(F.sum("share")).scalar(), sums.agg(F.sum("held")).scalar()
        tables.append(
            sums.select(
                F.lit(key).alias("dimension"),
                F.col(key).alias("value"),
                F.when(shares > 0, F.col("share") / shares).otherwise(0.0).alias("share"),
                F.when(all_held > 0, F.col("held") / all_held).otherwise(0.0).alias("reached"),
            )
        )
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def largest_difference(raked: DataFrame, names: Sequence[str]) -> float:
    """The largest relative difference of a share from its target, 0 without any."""
    off = F.abs(F.col("reached") / F.col("share") - 1)
    found = shares_held(raked, names, F.col("weight")).where("share > 0").agg(F.max(off).alias("off")).first()
    return found["off"] or 0.0


def calibrated(raked: DataFrame) -> DataFrame:
    """The raked cells with `probability`, at most 1 and 1 in some cell."""
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    ratios = raked.withColumn("ratio", ratio)
    most = ratios.agg(F.max("ratio")).scalar()
    return ratios.select(
        *raked.columns, F.when(most > 0, F.col("ratio") / most).otherwise(0.0).alias("probability")
    )


def budgeted(raked: DataFrame, budget: float) -> DataFrame:
    """The raked cells with their shares, with a `probability` that keeps `budget` of all tokens."""
    names = [name for name in raked.columns if f"share_{name}" in raked.columns]
    sums = raked.agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).first()
    asked = budget * (sums["tokens"] or 0)
    if not asked or not sums["weight"]:
        return raked.withColumn("probability", F.lit(0.0))
    part = F.col("weight") * F.lit(asked / sums["weight"])
    parts = kept(raked.withColumns({"part": part, "whole": F.lit(False)}))
    few = parts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    for _ in range(ROUNDS):
        over = ~F.col("whole") & (F.col("part") > F.col("tokens") * (1 + TOLERANCE / 10))
        if parts.where(over).isEmpty():
            break
        part = F.least("part", F.col("tokens").cast("double"))
        parts = kept(parts.withColumns({"whole": F.col("whole") | over, "part": part}))
        parts = rest_raked(parts, names, asked, few)
    else:
        log.warning("cells to be kept whole were still found after %d rounds", ROUNDS)
    factor = budget_factor(parts, asked)
    chance = F.least(F.lit(1.0), F.col("part") * F.lit(factor) / F.col("tokens"))
    chances = kept(
        parts.withColumn("probability", F.when(F.col("tokens") > 0, chance).otherwise(0.0)).drop("part", "whole")
    )
    report(chances, names, asked)
    return chances


def rest_raked(parts: DataFrame, names: Sequence[str], asked: float, few: bool) -> DataFrame:
    """`part` of the cells that are not whole, raked to what the whole ones leave of the shares."""
    fixed = F.when(F.col("whole"), F.col("part")).otherwise(0.0)
    free = F.when(F.col("whole"), 0.0).otherwise(F.col("part"))
    rest = asked - parts.agg(F.sum(fixed).alias("n")).first()["n"]
    last = float("inf")
    for done in range(1, MOST_SWEEPS + 1):
        parts = parts.withColumn("before", F.col("part"))
        for key in names:
            sums = parts.groupBy(key).agg(
                F.first(f"share_{key}").alias("share"), F.sum(fixed).alias("fixed"), F.sum(free).alias("held")
            )
            remains = F.greatest(F.col("share") * asked - F.col("fixed"), F.lit(0.0))
            sums = sums.select(key, "held", F.when(F.col("held") > 0, remains).otherwise(0.0).alias("remains"))
            total = sums.agg(F.sum("remains")).scalar()
            scaled = sums.select(
                key,
                F.when((F.col("held") > 0) & (total > 0), F.col("remains") / F.col("held") / total * rest)
                .otherwise(1.0)
                .alias("factor"),
            )
            part = F.when(F.col("whole"), F.col("part")).otherwise(F.col("part") * F.col("factor"))
            parts = kept(parts.join(F.broadcast(scaled) if few else scaled, key).withColumn("part", part).drop("factor"))
        change = F.abs(F.col("part") / F.col("before") - 1)
        found = parts.where("before > 0").agg(F.max(change).alias("off")).first()
        off, parts = found["off"] or 0.0, parts.drop("before")
        if off <= TOLERANCE / 10 or off > last * (1 - GAIN):
            break
        last = off
    return parts


def budget_factor(parts: DataFrame, asked: float) -> float:
    """The number c with which the sum of least(tokens, c * part) is what is asked, by Newton's
    method: the sum is concave in c, so the steps end at the cells that c keeps whole."""
    c = 1.0
    for _ in range(100):
        whole = F.col("part") * F.lit(c) >= F.col("tokens")
        found = parts.where("part > 0").agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0)).alias("whole"),
            F.sum(F.when(whole, 0.0).otherwise(F.col("part"))).alias("free"),
        ).first()
        if not found["free"]:
            break
        better = (asked - found["whole"]) / found["free"]
        if abs(better - c) <= 1e-12 * c:
            break
        c = better
    return c


def report(chances: DataFrame, names: Sequence[str], asked: float) -> None:
    """Log the shares that are not reached, the furthest off first, and a budget that is not."""
    amount = F.col("tokens") * F.col("probability")
    reached = chances.agg(F.sum(amount).alias("n")).first()["n"]
    if abs(reached / asked - 1) > TOLERANCE:
        log.warning("%.0f of %.0f tokens asked for can be kept", reached, asked)
    off = F.abs(F.col("reached") - F.col("share"))
    missed = shares_held(chances, names, amount).where(off > F.col("share") * TOLERANCE).orderBy(off.desc())
    for row in missed.limit(20).collect():
        log.warning("share of %s %r: %.4g asked for, %.4g reached", row.dimension, row.value, row.share, row.reached)


def chances_of(
    summed: DataFrame,
    dims: Mapping[str, Column],
    targets: Mapping[str, DataFrame] | None = None,
    alpha: float = 0.9,
    sweeps: int | None = None,
    budget: float | None = None,
    exact: bool = False,
) -> DataFrame:
    """The `cells` with their target shares, weight and probability; settings as of `mixed`."""
    if budget is None and not targets and not exact:
        budget = BUDGET
    shares = []
    for name, key in zip(dims, key_names(dims)):
        if targets and name in targets:
            value = F.coalesce(F.concat(F.lit("="), F.col("value").cast("string")), F.lit(""))
            shares.append(targets[name].select(value.alias(key), F.col("share").cast("double")))
        else:
            shares.append(tempered(summed, key, alpha))
    raked = raked_with_shares(summed, shares, sweeps)
    return calibrated(raked) if budget is None or exact else budgeted(raked, budget)


def shares_reached(docs: DataFrame, dims: Mapping[str, Column], text: str = "text", **settings) -> DataFrame:
    """dimension, value (null among them), the `share` asked for and the one `reached` by the expected
    tokens, for every value with tokens: what a caller checks before a sample is drawn."""
    chances = kept(chances_of(kept(cells(docs, dims, text)), dims, **settings))
    held = shares_held(chances, key_names(dims), F.col("tokens") * F.col("probability"))
    named = F.create_map(*(F.lit(x) for pair in zip(key_names(dims), dims) for x in pair))
    value = F.when(F.col("value") != "", F.substring("value", 2, 1 << 30))
    return held.select(named[F.col("dimension")].alias("dimension"), value.alias("value"), "share", "reached")


def mixed(
    docs: DataFrame,
    dims: Mapping[str, Column],
    targets: Mapping[str, DataFrame] | None = None,
    alpha: float = 0.9,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: str = "mix",
    sweeps: int | None = None,
    budget: float | None = None,
    exact: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """`doc`, a struct of the columns of `docs`, its tokens, cell weight, probability and
    whether it is `kept`.

    `targets` has a table (value, share) for each dimension that is not to have the tempered
    shares of the documents themselves. `budget` and `exact` say how much is kept, see above.
    A caller who wants no text names the columns to `keep`: the texts are then read once, as a narrow
    table of their keys and tokens stays.
    """
    names = key_names(dims)
    rows = docs.select(
        F.struct(*(keep or "*")).alias("doc"),
        *dimension_keys(dims),
        token_count(F.col(text)).alias("tokens"),
        draw(doc_id, text, seed).alias("draw"),
    )
    if keep is not None:
        rows = stored(rows, "mixed-rows")
    summed = kept(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    chances = chances_of(summed, dims, targets, alpha, sweeps, budget, exact)
    chances = kept(chances.select(*names, "weight", "probability"))
    return rows.join(small(chances), names).select(
        "doc", "tokens", "weight", "probability", (F.col("draw") < F.col("probability")).alias("kept")
    )


def sample(docs: DataFrame, dims: Mapping[str, Column], **settings) -> DataFrame:
    """The rows of `docs` that are drawn, with all their columns."""
    return mixed(docs, dims, **settings).where("kept").select("doc.*")
