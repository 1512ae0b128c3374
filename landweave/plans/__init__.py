"""Flows made of several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landweave.operators.potential import Intervention, change_quantities, shortlist, transition_potential
from landweave.operators.rates import transition_rates, viable_table


def identify_transitions(cells: DataFrame, periods: list[tuple[str, str, str]]) -> DataFrame:
    """Transitions of the whole map with rates by period and a three-digit id; the ids run over class pairs, a few dozen."""
    whole = viable_table(cells, periods).filter("region_name = 'whole_map' AND from_v <> to_v").drop("region_name")
    return whole.withColumn("trans_id", F.lpad(F.row_number().over(Window.orderBy("from_v", "to_v")).cast("string"), 3, "0"))


def time_step(cells: DataFrame, before: str, now: str, scored: DataFrame, zones: list[tuple[DataFrame, Intervention]], expanders: DataFrame, prune: float = 10.0) -> DataFrame:
    """Candidate cells of one simulated step: potentials under the interventions, quantities from the last rates, best cells of each transition."""
    potential = transition_potential(scored, cells, zones).filter("to_v IS NOT NULL")
    return shortlist(potential, change_quantities(cells, now, transition_rates(cells, before, now), expanders), prune)
