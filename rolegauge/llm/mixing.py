"""Mixing sources to target weights by iterative proportional fitting, then sampling by calibrated probabilities.

Documents are counted in cells (source, language, topic). A cell's factor is a product of one number per margin value, and its probability
is that factor, at most 1; in every sweep the numbers are solved again for the cells below 1, so cells that are used up do not hold the
others down. The draw meets a token budget: `budget` times the live tokens if that is given, else the largest one at which every value with a
target share of LEAST_SHARE or more can get its share. Smaller values get all they have, if that is less than their share, and the other
values take the rest. The expected tokens meet the budget and the targets as far as the cells allow. The registered query, the pipeline and
`sample_mixture` share this calibration. `rake` is the fit alone, without a cap.

A document is drawn if a number between 0 and 1 made from the MD5 of its id lies below the probability: the same id is always treated
alike, and repeated rows go together.

DataFrame functions only. Sums are aggregated before any shuffle, so a hot source is no hot task. A sweep is a window over each margin of
the cells; SWEEPS_AT_ONCE sweeps are one plan, and cells are spread over one partition for each CELLS_AT_ONCE of them: while there is one, its
sweeps need no shuffle. Per margin only sums reach the driver. Written intermediate tables are removed when the next one is there.

A null source, language or topic is the value NONE. Null and empty texts have no tokens; they are drawn like the rest of their cell, and
a cell without tokens is never drawn. A margin value that the targets do not name gets a share of 0; targets without data are left out
and the rest scaled to 1. All columns stay in `sample_mixture`, whatever their names, and are not read otherwise. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolegauge.storage import materialize, remove

SWEEPS, SWEEPS_AT_ONCE = 15, 5
CELLS_AT_ONCE = 1_000_000
LEAST_SHARE = 0.01
NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]+"
#: Target shares of the registered query: tokens of each value to these powers.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.5}
MARGINS = tuple(POWERS)


def token_count(text: str = "text") -> Column:
    """Blank-separated words."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def form_topic(text: str = "text", tokens: str = "n_tokens") -> Column:
    """The kind of text, for tables without a topic: by its marks and its length."""
    t = F.col(text)
    return (
        F.when(F.contains(t, F.lit(" | ")), "listing")
        .when(F.contains(t, F.lit("!!")), "shouting")
        .when(F.coalesce(t.rlike(r"[#$%&*]{3}"), F.lit(False)), "marked")
        .when(F.col(tokens) < 100, "short")
        .when(F.col(tokens) < 1000, "medium")
        .otherwise("long")
    )


def described(documents: DataFrame, topic: Column | None = None) -> DataFrame:
    """The documents with the working columns __source, __lang, __topic and __tokens."""
    rows = documents.withColumn("__tokens", token_count())
    label = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    kind = form_topic(tokens="__tokens") if topic is None else topic
    return rows.withColumns({"__source": label(F.col("source")), "__lang": label(F.col("lang")), "__topic": label(kind)})


def cell_table(rows: DataFrame) -> DataFrame:
    named = [F.col(f"__{m}").alias(m) for m in MARGINS]
    return materialize(rows.groupBy(*named).agg(F.sum("__tokens").cast("double").alias("tokens")), "cells")


def margin_sums(cells: DataFrame, margins: list[str]) -> DataFrame:
    """(margin, value, own): the tokens of each value."""
    values = F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in margins])
    rows = cells.where("tokens > 0").select(F.explode(values).alias("v"), "tokens")
    return rows.groupBy("v.margin", "v.value").agg(F.sum("tokens").alias("own"))


def by_margin(values: dict[str, float]) -> Column:
    """The number of the row's margin."""
    return F.coalesce(*[F.when(F.col("margin") == m, F.lit(float(x))) for m, x in values.items()], F.lit(0.0))


def power_targets(cells: DataFrame, powers: dict[str, float] = POWERS) -> dict[str, DataFrame]:
    """Share of each value: its tokens to a power below 1, which lifts small values."""
    return {m: cells.groupBy(m).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("share")) for m, power in powers.items()}


def targeted(cells: DataFrame, targets: dict[str, DataFrame] | None) -> tuple[DataFrame, DataFrame]:
    """The cells with tokens and a share in every margin, and (margin, value, own, share) of the values they have."""
    margins = list(targets or POWERS)
    live = cells.where("tokens > 0").select(*MARGINS, "tokens")
    if targets is None:
        return live, margin_sums(live, margins).withColumn("share", F.pow("own", by_margin(POWERS)))
    for margin, target in targets.items():  # a value without a share takes its cells out
        live = live.join(target.where("share > 0").select(margin), margin, "left_semi")
    live = materialize(live.select(*MARGINS, "tokens"), "cells")
    shares = [t.select(F.lit(m).alias("margin"), F.col(m).alias("value"), F.col("share").cast("double").alias("share")) for m, t in targets.items()]
    named = shares[0]
    for more in shares[1:]:
        named = named.union(more)
    return live, margin_sums(live, margins).join(named, ["margin", "value"])


def wanted_tokens(sides: DataFrame, budget: float | None) -> tuple[DataFrame, float]:
    """(margin, value, wanted) and the share of all tokens that is asked for: tokens by share, at most all that a value has; what it lacks goes
    to the other values of the margin."""
    sides = materialize(sides, "margins")
    whole = {r.margin: r for r in sides.groupBy("margin").agg(F.sum("share").alias("share"), F.sum("own").alias("own")).collect()}
    if not whole:
        return sides.select("margin", "value", F.col("own").alias("wanted")), 0.0
    total = max(r.own for r in whole.values())
    sides = sides.withColumn("share", F.col("share") / by_margin({m: r.share for m, r in whole.items()}))
    if budget is None:
        most = sides.where(F.col("share") >= LEAST_SHARE).agg(F.min(F.col("own") / F.col("share"))).first()[0]
        asked = total if most is None else min(total, most)
    else:
        asked = min(1.0, budget) * total
    level = dict.fromkeys(whole, asked)
    over = lambda: F.col("share") * by_margin(level) >= F.col("own")
    while True:
        state = sides.groupBy("margin").agg(F.sum(F.when(over(), F.col("own"))).alias("used"), F.sum(F.when(~over(), F.col("share"))).alias("open")).collect()
        after = {r.margin: (asked - (r.used or 0.0)) / r.open if r.open else level[r.margin] for r in state}
        if all(after[m] <= level[m] * (1 + 1e-9) for m in level):
            break
        level = {m: max(level[m], after[m]) for m in level}
    return sides.select("margin", "value", F.least(F.col("share") * by_margin(level), F.col("own")).alias("wanted")), asked / total


def swept(cells: DataFrame, wanted: DataFrame, margins: list[str], begin: float, sweeps: int, cap: bool) -> DataFrame:
    """The cells with their factor. Each sweep gives the values of every margin the tokens they want."""
    for m in margins:
        own = wanted.where(F.col("margin") == m).select(F.col("value").alias(m), F.col("wanted").alias(f"wanted_{m}"))
        cells = cells.join(own, m)
    cells = materialize(cells.withColumn("factor", F.lit(float(begin))), "cells")
    spread = max(1, math.ceil(cells.count() / CELLS_AT_ONCE))
    for done in range(0, sweeps, SWEEPS_AT_ONCE):
        after = cells.repartition(spread, margins[0])
        for _ in range(min(SWEEPS_AT_ONCE, sweeps - done)):
            for m in margins:
                used = F.col("tokens") * (F.least(F.lit(1.0), F.col("factor")) if cap else F.col("factor"))
                after = after.withColumn("now", F.sum(used).over(Window.partitionBy(m)))
                after = after.withColumn("factor", F.col("factor") * F.when(F.col("now") > 0, F.col(f"wanted_{m}") / F.col("now")).otherwise(0.0))
        after = materialize(after.drop("now"), "cells")
        remove(cells)
        cells = after
    return cells.select(*MARGINS, "tokens", "factor")


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """The cells with weights fitted to the targets: as many tokens as there are, without a cap on what a cell gives."""
    live, sides = targeted(cells, targets)
    sides = materialize(sides, "margins")
    whole = {r.margin: r for r in sides.groupBy("margin").agg(F.sum("share").alias("share"), F.sum("own").alias("own")).collect()}
    wanted = sides.select("margin", "value", (F.col("share") * by_margin({m: r.own / r.share for m, r in whole.items()})).alias("wanted"))
    fitted = swept(live, wanted, list(targets or POWERS), 1.0, sweeps, cap=False)
    return fitted.select(*MARGINS, "tokens", (F.col("tokens") * F.col("factor")).alias("weight"))


def capped_probabilities(cells: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float | None = None) -> DataFrame:
    """(__source, __lang, __topic, weight, probability) of each cell, calibrated to a token budget with probabilities of at most 1."""
    live, sides = targeted(cells, targets)
    wanted, begin = wanted_tokens(sides, budget)
    fitted = swept(live, wanted, list(targets or POWERS), begin, SWEEPS, cap=True)
    found = fitted.select(*MARGINS, F.least(F.lit(1.0), F.col("factor")).alias("__probability"))
    named = [F.col(m).alias(f"__{m}") for m in MARGINS]
    out = cells.join(found, list(MARGINS), "left").withColumn("__probability", F.coalesce("__probability", F.lit(0.0)))
    return out.select(*named, (F.col("tokens") * F.col("__probability")).alias("__weight"), "__probability")


def draw(doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) made from the id."""
    head = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(2.0**32)


def mixed(documents: DataFrame, topic: Column | None = None, targets: dict[str, DataFrame] | None = None, budget: float | None = None) -> DataFrame:
    """The documents with the working columns, __weight (expected tokens) and __probability of their cell, and __drawn."""
    rows = described(documents, topic)
    fitted = materialize(capped_probabilities(cell_table(rows), targets, budget), "fitted")
    return rows.join(fitted, [f"__{m}" for m in MARGINS]).withColumn("__drawn", draw() < F.col("__probability"))


def mixture_weights(documents: DataFrame, topic: Column | None = None, targets: dict[str, DataFrame] | None = None, budget: float | None = None) -> DataFrame:
    """One row per document: doc_id, topic, n_tokens, cell_weight (expected tokens of its cell), probability, sampled."""
    own = [documents[c] for c in ("doc_id", "text", "source", "lang")]
    rows = mixed(documents.select(*own, *([topic.alias("__own")] if topic is not None else [])), None if topic is None else F.col("__own"), targets, budget)
    return rows.select(
        "doc_id", F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"), F.round("__weight", 3).alias("cell_weight"),
        F.round("__probability", 9).alias("probability"), F.col("__drawn").alias("sampled"),
    )


def sample_mixture(documents: DataFrame, topic: Column | None = None, targets: dict[str, DataFrame] | None = None, budget: float | None = None) -> DataFrame:
    """The drawn documents, with all their columns."""
    own = [documents[c] for c in ("doc_id", "text", "source", "lang")]
    whole = F.struct(*[documents[c] for c in documents.columns]).alias("__row")
    rows = documents.select(*own, whole, *([topic.alias("__own")] if topic is not None else []))
    return mixed(rows, None if topic is None else F.col("__own"), targets, budget).where("__drawn").select("__row.*")
