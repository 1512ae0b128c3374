"""Scenario rates and areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.ranks import kept


def demand_targets(demand: DataFrame, areas: DataFrame, scalars: list[float], per_scenario: bool = True) -> DataFrame:
    """Target areas by region, scenario, class and scalar from respondents' sliders.

    A respondent's sliders of a class are summed, then averaged; final% = initial% + rate + |rate| * 2 * slider * s / 100 * confidence;
    areas below 0 are 0, and each region and scenario is rescaled to its initial total (per_scenario=False: to the total over scenarios).
    """
    per = demand.groupBy("region", "scenario", "lulc", "id").agg(F.sum("slider_value").alias("slider"), F.avg(F.coalesce("confidence_factor", F.lit(0.0))).alias("conf"), F.avg(F.coalesce("initial_rate", F.lit(0.0))).alias("rate"))
    mean = per.groupBy("region", "scenario", "lulc").agg(F.avg("slider").alias("slider"), F.avg("conf").alias("conf"), F.avg("rate").alias("rate"))
    rows = mean.join(areas.select("region", "lulc", F.col("n").alias("initial")), ["region", "lulc"])
    own = Window.partitionBy("region", "scenario") if per_scenario else Window.partitionBy("region")
    rows = rows.withColumn("total", F.sum("initial").over(own))
    rows = rows.crossJoin(F.broadcast(areas.sparkSession.createDataFrame([(float(s),) for s in scalars], "scalar double")))
    final = F.col("initial") * 100.0 / F.col("total") + F.col("rate") + F.abs("rate") * (2 * F.col("slider") * F.col("scalar") / 100) * F.col("conf")
    rows = rows.withColumn("raw", F.greatest(F.lit(0.0), final / 100 * F.col("total")))
    scale = F.try_divide(F.col("total").cast("double"), F.sum("raw").over(Window.partitionBy("region", "scenario", "scalar")))
    return rows.select("region", "scenario", "lulc", "scalar", "initial", (F.col("raw") * scale).alias("target"))


def transition_bounds(bounds: DataFrame, classes: DataFrame, stay_min: float = 0.5, stay_max: float = 0.999, smooth: float = 0.01, beta: float = 1.0, no_inflow: tuple[int, ...] = (), forbidden: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """By region and pair: least, greatest and mean rate (0, 1, 0 if unseen), persistence held in its range, forbidden ones 0, preference and weight."""
    regions = bounds.select("region").distinct()
    i, j = (classes.select(F.col("value").alias(c)) for c in ("from_v", "to_v"))
    grid = regions.crossJoin(F.broadcast(i)).crossJoin(F.broadcast(j)).join(bounds, ["region", "from_v", "to_v"], "left")
    stay = F.col("from_v") == F.col("to_v")
    closed = F.col("to_v").isin(*no_inflow) & ~stay if no_inflow else F.lit(False)
    for a, b in forbidden:
        closed = closed | ((F.col("from_v") == a) & (F.col("to_v") == b))
    low = F.when(closed, 0.0).when(stay, F.greatest(F.coalesce("min_rate", F.lit(0.0)), F.lit(stay_min))).otherwise(F.coalesce("min_rate", F.lit(0.0)))
    high = F.when(closed, 0.0).when(stay, F.least(F.coalesce("max_rate", F.lit(1.0)), F.lit(stay_max))).otherwise(F.coalesce("max_rate", F.lit(1.0)))
    mean = F.when(closed, 0.0).otherwise(F.coalesce("mean_rate", F.lit(0.0)))
    rows = grid.select("region", "from_v", "to_v", low.alias("min_rate"), high.alias("max_rate"), mean.alias("mean_rate"), closed.alias("zero"))
    pref = (F.col("mean_rate") + smooth) / F.sum(F.col("mean_rate") + smooth).over(Window.partitionBy("region", "from_v"))
    return rows.withColumn("preference", pref).withColumn("weight", 1 + beta * F.col("preference"))


def flows_to_rates(flows: DataFrame, areas: DataFrame, keys: list[str]) -> DataFrame:
    """Rate = flow / max(area of the from-class, 1e-12)."""
    out = flows.join(areas, [*keys, "from_v"])
    return out.select(*keys, "from_v", "to_v", (F.col("flow") / F.greatest("area", F.lit(1e-12))).alias("rate"))


def project_areas(areas: DataFrame, rates: DataFrame, steps: list[int], keys: list[str]) -> DataFrame:
    """(keys, lulc, step, area): area + gains - losses, step after step; all keys at once.

    rates may carry a column step, else they hold for all. Each key is one row, with its classes' areas as an array and its
    rates by step as a map, and one fold over the steps takes it from the first to the last: one job, however many steps.
    """
    one = F.struct("lulc", F.col("area").cast("double").alias("area"))
    own = areas.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("__areas")) if keys else areas.agg(F.sort_array(F.collect_list(one)).alias("__areas"))
    rate = F.struct("from_v", "to_v", F.col("rate").cast("double").alias("rate"))
    by_step = "step" in rates.columns
    lists = rates.filter(F.col("step").isin(*steps[1:])) if by_step else rates
    lists = lists.groupBy(*keys, F.col("step").cast("int").alias("step") if by_step else F.lit(0).alias("step")).agg(F.sort_array(F.collect_list(rate)).alias("list"))
    lists = lists.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("step", "list"))).alias("__rates"))
    both = own.join(lists, keys, "left") if keys else own.crossJoin(F.broadcast(lists))

    def moved(now: Column, step: Column) -> Column:
        own_rates = F.try_element_at("__rates", step if by_step else F.lit(0))
        area = lambda c: F.aggregate(F.filter(now, lambda x: x["lulc"] == c), F.lit(0.0), lambda s, x: s + x["area"])
        flows = F.transform(own_rates, lambda r: F.struct(r["from_v"].alias("from_v"), r["to_v"].alias("to_v"), (r["rate"] * area(r["from_v"])).alias("flow")))
        total = lambda f, side, c: F.aggregate(F.filter(f, lambda r: r[side] == c), F.lit(0.0), lambda s, r: s + r["flow"])
        # flows once a step: a list of one, looked through
        new = F.transform(F.array(flows), lambda f: F.transform(now, lambda x: F.struct(x["lulc"].alias("lulc"), (x["area"] + total(f, "to_v", x["lulc"]) - total(f, "from_v", x["lulc"])).alias("area"))))
        return F.when(own_rates.isNull(), now).otherwise(F.get(new, 0))

    start = F.array(F.struct(F.lit(steps[0]).alias("step"), F.col("__areas").alias("areas")))

    def on(done: Column, step: Column) -> Column:
        return F.concat(done, F.array(F.struct(step.alias("step"), moved(F.element_at(done, -1)["areas"], step).alias("areas"))))

    out = both.select(*keys, F.explode(F.aggregate(F.array(*map(F.lit, steps[1:])).cast("array<int>"), start, on)).alias("x")) if len(steps) > 1 else both.select(*keys, F.explode(start).alias("x"))
    return out.select(*keys, F.explode("x.areas").alias("a"), F.col("x.step").alias("step")).select(*keys, "a.lulc", "a.area", "step")


def area_trajectories(projected: DataFrame, keys: list[str], steps: list[int]) -> DataFrame:
    """One row a class: area by step, percent of the first total, and a label of start and end."""
    wide = projected.groupBy(*keys, "lulc").pivot("step", steps).agg(F.first("area"))
    first, last = F.col(str(steps[0])), F.col(str(steps[-1]))
    total = F.sum(first).over(Window.partitionBy(*keys)) if keys else F.sum(first).over(Window.partitionBy())
    return wide.select(*keys, "lulc", *(F.col(str(s)).alias(f"area_{s}") for s in steps), (last * 100 / total).alias("perc_end"), F.format_string("%d -> %d", F.round(first).cast("long"), F.round(last).cast("long")).alias("label"))


def scenario_areas(expected: DataFrame, keys: list[str], steps: int) -> DataFrame:
    """Expected areas rescaled where they exceed what is there, then a straight line of steps from initial to expected."""
    w = Window.partitionBy(*keys)
    have, want = F.sum("initial").over(w), F.sum("expected").over(w)
    rows = expected.withColumn("expected", F.when(want > have, F.col("expected") * have / want).otherwise(F.col("expected").cast("double")))
    step = (F.col("expected") - F.col("initial")) / steps
    return rows.withColumn("step_change", step).select(*keys, "lulc", "step_change", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("step"), "initial").select(*keys, "lulc", "step", "step_change", (F.col("initial") + F.col("step_change") * F.col("step")).alias("area"))


def rebalance_class(areas: DataFrame, series: DataFrame, keys: list[str], cls: int, other: int) -> DataFrame:
    """A class's area by a modelled series; the difference goes to another class."""
    got = series.select(*keys, F.col("area").alias("modelled"))
    gap = areas.filter(F.col("lulc") == cls).join(got, keys).select(*keys, (F.col("area") - F.col("modelled")).alias("gap"), "modelled")
    out = areas.join(gap, keys, "left")
    new = F.when((F.col("lulc") == cls) & F.col("modelled").isNotNull(), F.col("modelled")).when(F.col("lulc") == other, F.col("area") + F.coalesce("gap", F.lit(0.0))).otherwise(F.col("area"))
    return out.select(*areas.columns[: areas.columns.index("area")], new.alias("area"))


def distribute_change(net: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """Net class changes as transitions: gains by each transition's share of its to-class, losses by its share of its from-class, never below 0."""
    w = lambda c: Window.partitionBy(*keys, c)
    shares = reference.withColumns({"gain_share": F.try_divide(F.col("amount"), F.sum("amount").over(w("to_v"))), "loss_share": F.try_divide(F.col("amount"), F.sum("amount").over(w("from_v")))})
    side = lambda c: net.select(*keys, F.col("lulc").alias(c), F.col("change").alias(f"d_{c}"))
    out = shares.join(side("to_v"), [*keys, "to_v"], "left").join(side("from_v"), [*keys, "from_v"], "left")
    part = F.coalesce(F.greatest("d_to_v", F.lit(0.0)) * F.col("gain_share"), F.lit(0.0)) + F.coalesce(F.greatest(-F.col("d_from_v"), F.lit(0.0)) * F.col("loss_share"), F.lit(0.0))
    return out.select(*keys, "from_v", "to_v", F.greatest(F.lit(0.0), F.col("amount") + part).alias("amount"))


def area_mismatch(trans: DataFrame, areas: DataFrame, keys: list[str]) -> DataFrame:
    """By class: initial, desired and projected area, mismatch and its percent of desired."""
    flow = trans.select(*keys, F.explode(F.array(F.struct(F.col("to_v").alias("lulc"), F.col("amount").alias("d")), F.struct(F.col("from_v").alias("lulc"), (-F.col("amount")).alias("d")))).alias("x")).groupBy(*keys, F.col("x.lulc").alias("lulc")).agg(F.sum("x.d").alias("net"))
    out = areas.join(flow, [*keys, "lulc"], "left").withColumn("projected", F.col("initial") + F.coalesce("net", F.lit(0.0)))
    gap = F.col("projected") - F.col("desired")
    return out.select(*keys, "lulc", "initial", "desired", "projected", gap.alias("mismatch"), F.try_divide(gap * 100.0, F.col("desired")).alias("mismatch_perc"))


def target_transitions(trans: DataFrame, mismatch: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Transitions that leave an oversized class or enter an undersized one; synergistic ones do both."""
    side = lambda c: mismatch.select(*keys, F.col("lulc").alias(c), F.col("mismatch").alias(f"m_{c}"), F.col("mismatch_perc").alias(f"q_{c}"))
    out = trans.join(side("from_v"), [*keys, "from_v"]).join(side("to_v"), [*keys, "to_v"])
    over, under = F.col("q_from_v") > threshold, F.col("q_to_v") < -threshold
    return out.filter(over | under).select(*keys, "from_v", "to_v", "amount", (F.col("amount") == 0).alias("zero"), (over & under).alias("synergistic"))


def total_mismatch(mismatch: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the sizes of mismatches, and of what is too small and too large in percent."""
    q = F.col("mismatch_perc")
    return mismatch.groupBy(*keys).agg(F.sum(F.abs("mismatch")).alias("total_area"), F.sum(F.abs(q)).alias("total_perc"), F.sum(F.when(q < 0, -q).otherwise(0.0)).alias("undersized"), F.sum(F.when(q > 0, q).otherwise(0.0)).alias("oversized"))


def synergistic_step(trans: DataFrame, areas: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Synergistic transitions grow by the mismatch of whichever of their classes has the lesser percentage, in
    those keys whose total mismatch falls by it; elsewhere trans stays."""
    m = kept(area_mismatch(trans, areas, keys))
    side = lambda c: m.select(*keys, F.col("lulc").alias(c), F.abs("mismatch").alias(f"a_{c}"), F.abs("mismatch_perc").alias(f"q_{c}"))
    hit = target_transitions(trans, m, keys, threshold).filter("synergistic").join(side("from_v"), [*keys, "from_v"]).join(side("to_v"), [*keys, "to_v"])
    hit = hit.select(*keys, "from_v", "to_v", F.when(F.col("q_from_v") >= F.col("q_to_v"), F.col("a_to_v")).otherwise(F.col("a_from_v")).alias("step"))
    grown = kept(trans.join(hit, [*keys, "from_v", "to_v"], "left").withColumn("grown", F.col("amount") + F.coalesce("step", F.lit(0.0))))
    after = total_mismatch(area_mismatch(grown.select(*keys, "from_v", "to_v", F.col("grown").alias("amount")), areas, keys), keys)
    better = total_mismatch(m, keys).select(*keys, F.col("total_perc").alias("before")).join(after, keys).select(*keys, (F.round("total_perc", 9) < F.round("before", 9)).alias("better"))
    out = grown.join(better, keys, "left")
    return out.withColumn("amount", F.when(F.col("better"), F.col("grown")).otherwise(F.col("amount"))).select(*trans.columns)


def improve_round(trans: DataFrame, areas: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """One round: synergistic transitions first (synergistic_step); then each class's mismatch goes to its target
    transitions by the inverse of the opposing classes' percentages (0 where that isn't finite; equally where all are 0).

    All classes at once, from the values after the first step; where two classes touch one transition, the one of
    the lesser percentage decides (then the greater class). For stepwise tables the step is one of the keys.
    """
    areas = kept(areas)
    now = kept(synergistic_step(kept(trans), areas, keys, threshold))
    m = kept(area_mismatch(now, areas, keys))
    hit = target_transitions(now, m, keys, threshold).select(*keys, "from_v", "to_v")
    side = lambda c: m.select(*keys, F.col("lulc").alias(c), F.col("mismatch").alias(f"m_{c}"), F.col("mismatch_perc").alias(f"q_{c}"))
    both = hit.join(side("from_v"), [*keys, "from_v"]).join(side("to_v"), [*keys, "to_v"])
    own = lambda c, other: F.struct(F.col(c).alias("cls"), F.abs(f"m_{c}").alias("gap"), F.abs(f"q_{c}").alias("perc"), F.abs(f"q_{other}").alias("opp"))
    served = F.array(F.when(F.col("q_to_v") < -threshold, own("to_v", "from_v")), F.when(F.col("q_from_v") > threshold, own("from_v", "to_v")))
    rows = both.select(*keys, "from_v", "to_v", F.explode(F.array_compact(served)).alias("s")).select(*keys, "from_v", "to_v", "s.*")
    group = Window.partitionBy(*keys, "cls")
    factor = F.coalesce(F.try_divide(F.sum("opp").over(group), F.col("opp")), F.lit(0.0))
    rows = rows.withColumn("factor", factor)
    part = F.coalesce(F.try_divide(F.col("factor"), F.sum("factor").over(group)), 1 / F.count("*").over(group))
    rows = rows.withColumn("add", F.col("gap") * part)
    last = rows.groupBy(*keys, "from_v", "to_v").agg(F.min_by("add", F.struct("perc", -F.col("cls"))).alias("add"))
    return now.join(last, [*keys, "from_v", "to_v"], "left").withColumn("amount", F.col("amount") + F.coalesce("add", F.lit(0.0))).select(*trans.columns)


def best_sweep(results: DataFrame, scenario: str, score: str) -> DataFrame:
    """The threshold and repetition of least total mismatch by scenario; ties to the smaller threshold, then repetition."""
    order = F.struct(F.col(score), "threshold", "repetition")
    return results.groupBy(scenario).agg(F.min(order).alias("b")).select(scenario, "b.threshold", "b.repetition", F.col(f"b.{score}").alias(score))


def areas_to_rates(trans: DataFrame, areas: DataFrame, keys: list[str]) -> DataFrame:
    """Transition area over its class's area one step before."""
    before = areas.select(*keys, F.col("lulc").alias("from_v"), (F.col("step") + 1).alias("step"), F.col("area").alias("before"))
    return trans.join(before, [*keys, "from_v", "step"]).select(*keys, "step", "from_v", "to_v", F.try_divide(F.col("amount"), F.col("before")).alias("rate"))


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)
