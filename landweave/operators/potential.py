"""Transition potentials, policy interventions, deterministic cells and change quantities."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.ranks import kept, percentiles, ranked


def at_digits(c: str | Column) -> Column:
    """A value as cuts compare it: to nine digits, so that sums in another order fall on the same side."""
    return F.round(c, 9)


def normalize_long(probs: DataFrame) -> DataFrame:
    """A cell's probabilities over their sum (to twelve digits, so that its order makes no difference) where it exceeds 1."""
    total = F.round(F.sum("p").over(Window.partitionBy("cell_id")), 12)
    return probs.withColumn("p", F.when(total > 1, F.col("p") / total).otherwise(F.col("p")))


@dataclass(frozen=True)
class Intervention:
    """kind absolute sets value, relative scales by the gap of the upper tails (see adjust_relative); zone: which side of the mask is meant."""

    kind: str
    zone: str = "inside"
    value: float = 0.0
    q_in: float = 0.9
    q_out: float = 0.9
    threshold: float = 0.05
    order: str = "in-out"
    when_positive: str = "raise_outside"
    when_negative: str = "lower_inside"
    targets: tuple[int, ...] = ()
    from_filter: tuple[int, ...] = ()
    guard: bool = False
    note: str = field(default="", compare=False)

    @classmethod
    def configured(cls, row: dict, classes: dict[str, int]) -> Intervention:
        """From a configured row (lower-case names; numbers in percent), with class values by name."""
        number = lambda c, default: default if row.get(c) is None else float(row[c]) / 100
        values = lambda c: tuple(classes[x] for x in row.get(c) or () if x)
        zone, kind = (row.get("prob_adjust_zone") or "inside").lower(), row["prob_adjust_type"].lower()
        valency = (row.get("prob_adjust_valency") or "increase").lower()
        if zone not in ("inside", "outside") or kind not in ("absolute", "relative") or (kind == "relative" and valency not in VALENCIES):
            raise ValueError(f"unknown type, zone or valency of {row.get('intervention_id')}: {kind}, {zone}, {valency}")
        positive, negative = VALENCIES.get(valency, VALENCIES["increase"])
        return cls(
            kind, zone, number("prob_adjust_value", 0.0), number("prob_adjust_intervention_percentile", 0.9), number("prob_adjust_non_intervention_percentile", 0.9),
            number("prob_adjust_threshold", 0.05), "in-out", positive, negative, values("target_classes"), values("from_lulc_filter"),
        )


#: What a configured valency does to the zone's upper tail where the gap is positive, and where it is negative: fixed values.
VALENCIES = {"increase": ("raise_inside", "raise_inside"), "decrease": ("lower_inside", "lower_inside"), "increase_inside_decrease_outside": ("raise_inside", "lower_outside")}


#: Presets by name: zone percentiles and reactions are fixed values.
PRESETS = {
    "densification": Intervention("absolute", "inside", 1.0, targets=(105,)),
    "protection": Intervention("absolute", "inside", 0.0, targets=(105,)),
    "urban_sprawl": Intervention("relative", q_in=0.9, q_out=0.8, order="out-in", when_negative="lower_outside", when_positive="raise_inside", targets=(105,)),
    "urban_migration": Intervention("relative", q_in=0.9, q_out=0.8, order="out-in", when_negative="lower_inside", when_positive="raise_outside", targets=(105,)),
    "mountain_development": Intervention("relative", order="out-in", when_negative="lower_outside", when_positive="raise_inside", targets=(105,)),
    "rural_migration": Intervention("relative", order="out-in", when_negative="lower_outside", when_positive="raise_inside", targets=(105,)),
    "cultural_protection": Intervention("relative", order="out-in", when_negative="lower_inside", when_positive="raise_outside", targets=(105,), guard=True),
    "agri_expansion": Intervention("relative", order="out-in", when_positive="raise_inside", when_negative="lower_outside", targets=(103,), from_filter=(102, 104)),
    "ineffective_conservation": Intervention("relative", order="out-in", when_positive="raise_inside", when_negative="lower_outside", targets=(103, 104, 105)),
    "conservation": Intervention("absolute", "inside", 0.0, targets=(103, 105), from_filter=(102,)),
}


def _applies(i: Intervention) -> Column:
    ok = F.lit(True)
    if i.targets:
        ok = ok & F.col("to_v").isin(*i.targets)
    return ok & F.col("from_v").isin(*i.from_filter) if i.from_filter else ok


def _flag(probs: DataFrame, zone: DataFrame) -> DataFrame:
    return probs.join(zone.select("cell_id", F.lit(True).alias("__in")).distinct(), "cell_id", "left").withColumn("__in", F.coalesce("__in", F.lit(False)))


def adjust_absolute(probs: DataFrame, zone: DataFrame, i: Intervention) -> DataFrame:
    """Positive probabilities inside (or outside) the zone become value."""
    side = F.col("__in") if i.zone == "inside" else ~F.col("__in")
    return _flag(probs, zone).withColumn("p", F.when(side & (F.col("p") > 0) & _applies(i), F.lit(float(i.value))).otherwise(F.col("p"))).drop("__in")


def adjust_relative(probs: DataFrame, zone: DataFrame, i: Intervention) -> DataFrame:
    """Scale the upper tail on the side that the sign of the gap selects, for each target class.

    Percentiles of positive values inside and outside; means of the values at or above them; gap = their
    difference over their average, at least threshold in size; values above their side's percentile times
    1 + gap, held in [0, 1]. Four numbers for each target class meet the cells by broadcast. With zone outside
    the cells beyond the mask are the inside.
    """
    flagged = _flag(probs, zone)
    rows = kept(flagged if i.zone == "inside" else flagged.withColumn("__in", ~F.col("__in")))
    own = rows.filter(_applies(i) & (F.col("p") > 0))
    side = lambda inside, x: F.when(F.col("__in") == inside, x)
    differ = lambda inside: F.coalesce(F.min(side(inside, F.col("p"))) < F.max(side(inside, F.col("p"))), F.lit(False))
    q = own.groupBy("to_v").agg(differ(True).alias("d_in"), differ(False).alias("d_out"))
    both = percentiles(own, ["to_v", "__in"], "p", F.when(F.col("__in"), i.q_in).otherwise(i.q_out), [i.q_in, i.q_out])
    q = q.join(both.groupBy("to_v").agg(F.max(side(True, F.col("q"))).alias("q_in"), F.max(side(False, F.col("q"))).alias("q_out")), "to_v")
    means = own.join(F.broadcast(q), "to_v").groupBy("to_v", "q_in", "q_out", "d_in", "d_out").agg(F.avg(side(True, F.when(at_digits("p") >= at_digits("q_in"), F.col("p")))).alias("m_in"), F.avg(side(False, F.when(at_digits("p") >= at_digits("q_out"), F.col("p")))).alias("m_out"))
    gap = F.try_divide(F.col("m_in") - F.col("m_out") if i.order == "in-out" else F.col("m_out") - F.col("m_in"), (F.col("m_in") + F.col("m_out")) / 2)
    gap = F.when(F.abs(gap) < i.threshold, F.when(gap < 0, -i.threshold).otherwise(i.threshold)).otherwise(gap)
    if i.guard:
        gap = F.when(F.col("d_in") & F.col("d_out"), gap)
    stats = means.select(F.col("to_v").alias("__to"), "q_in", "q_out", gap.alias("gap"))

    def scaled(rule: str) -> Column:
        move, where = rule.split("_")
        factor = 1 + F.abs("gap") if move == "raise" else 1 - F.abs("gap")
        hit = (F.col("__in") & (at_digits("p") > at_digits("q_in"))) if where == "inside" else (~F.col("__in") & (at_digits("p") > at_digits("q_out")))
        return F.when(hit, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("p") * factor))).otherwise(F.col("p"))

    out = rows.join(F.broadcast(stats), F.col("to_v") == F.col("__to"), "left")
    new = F.when(F.col("gap") > 0, scaled(i.when_positive)).when(F.col("gap") < 0, scaled(i.when_negative)).otherwise(F.col("p"))
    return out.withColumn("p", F.when(_applies(i) & F.col("gap").isNotNull(), new).otherwise(F.col("p"))).drop("__in", "__to", "q_in", "q_out", "gap")


def apply_intervention(probs: DataFrame, zone: DataFrame, i: Intervention) -> DataFrame:
    return (adjust_absolute if i.kind == "absolute" else adjust_relative)(probs, zone, i)


def apply_configured(probs: DataFrame, active: DataFrame, zones: dict[str, DataFrame], classes: dict[str, int]) -> DataFrame:
    """All active interventions (a table of configuration's size) one after another in rank order; zones: cells of each id's mask."""
    for row in active.orderBy("rank", "intervention_id").collect():
        probs = apply_intervention(probs, zones[row["intervention_id"]], Intervention.configured(row.asDict(), classes))
    return probs


def active_interventions(ints: DataFrame, scenario: str, year: int) -> DataFrame:
    """Interventions of a scenario that list the year itself, in rank order."""
    return ints.filter((F.col("scenario_id") == scenario) & F.array_contains("time_step", year)).orderBy("rank", "intervention_id")


def marginality(df: DataFrame) -> DataFrame:
    """Mean of rescaled distance to roads, slope, elevation and of inverted distance to building zones."""
    from landweave.operators.grid import rescale01

    cols = ("dist_roads", "slope", "elevation", "dist_building")
    scaled = rescale01(df.select("cell_id", *cols), {c: c == "dist_building" for c in cols})
    return scaled.select("cell_id", (sum((F.col(c) for c in cols[1:]), F.col(cols[0])) / 4).alias("marginality"))


def abandonment(probs: DataFrame, index: DataFrame, threshold: float, agri: tuple[int, ...] = (103, 104)) -> DataFrame:
    """Agricultural cells: raise the upper tenth where marginal (index above its 75th percentile), lower it elsewhere, by threshold."""
    rows = kept(probs.filter(F.col("from_v").isin(*agri)).join(index, "cell_id"))
    cut = percentiles(rows.select("cell_id", "marginality").distinct(), [], "marginality", 0.75).withColumnRenamed("q", "cut")
    rows = rows.crossJoin(F.broadcast(cut)).withColumn("marginal", at_digits("marginality") > at_digits("cut"))
    q = percentiles(rows.filter("p > 0"), ["marginal"], "p", 0.9)
    out = rows.join(F.broadcast(q), "marginal", "left")
    factor = F.when(F.col("marginal"), 1 + threshold).otherwise(1 - threshold)
    return out.withColumn("p", F.when(at_digits("p") > at_digits("q"), F.least(F.lit(1.0), F.col("p") * factor)).otherwise(F.col("p"))).select(*probs.columns, "marginal")


def maintenance(probs: DataFrame, index: DataFrame, threshold: float, agri: tuple[int, ...] = (103, 104)) -> DataFrame:
    """Marginal agricultural probabilities above the 95th percentile of the non-marginal positive ones, lowered by threshold."""
    rows = kept(probs.filter(F.col("from_v").isin(*agri)).join(index, "cell_id"))
    cut = percentiles(rows.select("cell_id", "marginality").distinct(), [], "marginality", 0.75).withColumnRenamed("q", "cut")
    rows = rows.crossJoin(F.broadcast(cut)).withColumn("marginal", at_digits("marginality") > at_digits("cut"))
    q = percentiles(rows.filter("p > 0 AND NOT marginal"), [], "p", 0.95)
    out = rows.crossJoin(F.broadcast(q))
    return out.withColumn("p", F.when(F.col("marginal") & (at_digits("p") > at_digits("q")), F.col("p") * (1 - threshold)).otherwise(F.col("p"))).select(*probs.columns, "marginal")


def adjust_params(params: DataFrame, ints: DataFrame) -> DataFrame:
    """Parameters (to_v, year, name, value): set where absolute, scaled where relative, for listed classes and years."""
    rows = ints.select(F.explode("years").alias("year"), "classes", "name", "kind", F.col("value").alias("by")).select("year", F.explode("classes").alias("to_v"), "name", "kind", "by")
    out = params.join(rows, ["year", "to_v", "name"], "left")
    return out.select(*params.columns[:0], *(c for c in params.columns if c != "value"), F.when(F.col("kind") == "absolute", F.col("by")).when(F.col("kind") == "relative", F.col("value") * F.col("by")).otherwise(F.col("value")).alias("value"))


def typology_zone(cells: DataFrame, unit: str, typology: DataFrame, codes: list[int]) -> DataFrame:
    """Cells of units whose type code is listed: zone 1; others NULL."""
    joined = cells.join(typology, unit, "left")
    return joined.select("cell_id", F.when(F.col("code").isin(*codes), 1).alias("zone"))


def deterministic_override(cells: DataFrame, col: str, index: DataFrame, glacier: int = 107, static: int = 106) -> DataFrame:
    """Listed cells take the class of the list (glacier or not); other glacier cells become static."""
    out = cells.join(index.select("cell_id", F.col("is_glacier").alias("__g")), "cell_id", "left")
    now = F.when(F.col("__g") == 1, glacier).when(F.col("__g") == 0, static).when(F.col(col) == glacier, static).otherwise(F.col(col))
    return out.withColumn(col, now).drop("__g")


def drop_from_class(rates: DataFrame, classes: list[int]) -> DataFrame:
    return rates.filter(~F.col("from_v").isin(*classes))


def change_quantities(cells: DataFrame, col: str, rates: DataFrame, pct: DataFrame) -> DataFrame:
    """Cells to change by transition, split into expansion and the rest."""
    n = cells.groupBy(F.col(col).alias("from_v")).agg(F.count("*").alias("cells"))
    out = rates.join(n, "from_v").join(pct, ["from_v", "to_v"], "left")
    out = out.withColumn("n", F.round(F.col("rate") * F.col("cells")).cast("long"))
    expand = F.round(F.coalesce("perc_expander", F.lit(0.0)) / 100 * F.col("n")).cast("long")
    return out.select("from_v", "to_v", "n", expand.alias("n_expander"), (F.col("n") - expand).alias("n_patcher"))


def shortlist(probs: DataFrame, quantities: DataFrame, prune: float = 10.0) -> DataFrame:
    """The best prune * n cells of each transition, by probability (to twelve digits) and then cell."""
    rows = probs.filter("p > 0").join(F.broadcast(quantities.select("from_v", "to_v", "n")), ["from_v", "to_v"])
    out = ranked(rows, ["from_v", "to_v"], [F.round("p", 12).desc(), F.col("cell_id")], "rank").withColumn("rank", F.col("rank").cast("int"))
    return out.filter(F.col("rank") <= F.col("n") * prune).select(*probs.columns, "rank")


def transition_potential(scored: DataFrame, background: DataFrame, zones: list[tuple[DataFrame, Intervention]], between: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(cell_id, from_v, to_v, p) for all cells of the background: normalised, adjusted in order, normalised again, 0 where a cell has no score.

    scored: one row for each cell and model of its class. between: applied before the last normalising.
    """
    p = normalize_long(scored.select("cell_id", "from_v", "to_v", "p"))
    for zone, i in zones:
        p = apply_intervention(p, zone, i)
    p = normalize_long(between(p) if between else p)
    return background.select("cell_id").join(p, "cell_id", "left").withColumn("p", F.coalesce("p", F.lit(0.0)))
