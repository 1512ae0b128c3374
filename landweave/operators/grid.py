"""Maps as tables of cells: recoding, masks, windows and resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cell_id(row: Column, col: Column, ncol: int) -> Column:
    return ((row - 1) * ncol + col).cast("long")


def row_col(cell: Column, ncol: int) -> tuple[Column, Column]:
    """Row and column of a cell number, all from 1."""
    return (F.floor((cell - 1) / ncol) + 1).cast("int"), (F.pmod(cell - 1, F.lit(ncol)) + 1).cast("int")


def valid_cells(rows: DataFrame, ncol: int) -> DataFrame:
    """Cells that hold a value, from rows (row, values): row_idx (dense, in cell order), cell_id, row, col, value.

    Rows are counted first; the running sum runs over one number a row, and cells are numbered within
    their row, so no task sees the whole map.
    """
    kept = rows.select("row", F.filter(F.transform("values", lambda v, i: F.struct((i + 1).alias("col"), v.alias("value"))), lambda x: x["value"].isNotNull()).alias("kept"))
    before = rows.select("row", F.size(F.filter("values", lambda v: v.isNotNull())).alias("n"))
    before = before.select("row", (F.sum("n").over(Window.orderBy("row")) - F.col("n")).alias("before"))
    cells = kept.join(before, "row").select("row", "before", F.posexplode("kept").alias("k", "c"))
    return cells.select((F.col("before") + F.col("k") + 1).cast("long").alias("row_idx"), cell_id(F.col("row"), F.col("c.col"), ncol).alias("cell_id"), "row", F.col("c.col").alias("col"), F.col("c.value").alias("value"))


def reclassify(df: DataFrame, col: str, mapping: DataFrame, out: str) -> DataFrame:
    """out = the mapping's (old, new) of col; what isn't mapped is NULL."""
    return df.join(mapping.select(F.col("old").alias("__old"), F.col("new").alias(out)), F.col(col) == F.col("__old"), "left").drop("__old")


def layerize(df: DataFrame, col: str, classes: list[int], keep: list[str]) -> DataFrame:
    return df.select(*keep, *((F.col(col) == v).cast("int").alias(f"is_{v}") for v in classes))


def change_map(a: Column, b: Column) -> Column:
    """The new class where it differs."""
    return F.when(a == b, F.lit(None)).otherwise(b)


def transition_response(cells: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(cell_id, region, from_v, to_v, response): 1 if the cell goes from from_v to to_v, 0 if it was from_v and doesn't; no row elsewhere."""
    rows = cells.select("cell_id", "region", F.col(a).alias("from_v"), F.col(b).alias("now"))
    return rows.join(pairs.select("from_v", "to_v"), "from_v").select("cell_id", "region", "from_v", "to_v", (F.col("now") == F.col("to_v")).cast("int").alias("response"))


def response_wide(response: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """One column for each transition, NULL where the cell isn't of its from-class."""
    names = [f"{a}-{b}" for a, b in pairs]
    return response.withColumn("t", F.concat_ws("-", "from_v", "to_v")).groupBy("cell_id", "region").pivot("t", names).agg(F.first("response"))


def viable(rates: DataFrame, period: str) -> DataFrame:
    """Transitions of the whole map that have a rate in a period, named from-to."""
    return rates.filter((F.col("region_name") == "whole_map") & (F.col("from_v") != F.col("to_v")) & F.col(f"rate_{period}").isNotNull()).select("from_v", "to_v", F.concat_ws("-", "from_v", "to_v").alias("transition"))


def select_predictors(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """keys and names as doubles; fails if a cast loses a value, found in one pass."""
    casts = {n: F.col(n).try_cast("double") for n in names}
    lost = df.agg(*(F.sum((F.col(n).isNotNull() & c.isNull()).cast("long")).alias(n) for n, c in casts.items())).first().asDict()
    if bad := {n: k for n, k in lost.items() if k}:
        raise ValueError(f"not numeric: {bad}")
    return df.select(*keys, *(c.alias(n) for n, c in casts.items()))


def complete_cases(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """Rows by group before and after rows with any NULL in cols are dropped."""
    full = F.size(F.array_compact(F.array(*(F.col(c).cast("string") for c in cols)))) == len(cols)
    return df.groupBy(*by).agg(F.count("*").alias("n_before"), F.sum(full.cast("long")).alias("n_after"))


def constant_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with one value at most, by one pass."""
    got = df.agg(*(F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in cols)).first().asDict()
    return [c for c in cols if got[c]]


def drop_constant(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*constant_columns(df, cols))


def rescale01(df: DataFrame, cols: dict[str, bool]) -> DataFrame:
    """Columns on 0 to 1 by their least and greatest value, turned round where the flag says so."""
    ends = df.agg(*(f(c).alias(f"__{n}_{c}") for c in cols for n, f in (("a", F.min), ("b", F.max))))
    x = lambda c: F.try_divide(F.col(c) - F.col(f"__a_{c}"), F.col(f"__b_{c}") - F.col(f"__a_{c}"))
    return df.crossJoin(F.broadcast(ends)).select(*(c for c in df.columns if c not in cols), *((1 - x(c) if turn else x(c)).alias(c) for c, turn in cols.items()))


def normalize(df: DataFrame, cols: list[str]) -> DataFrame:
    """z-scores by mean and sample deviation."""
    ends = df.agg(*(f(c).alias(f"__{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))))
    return df.crossJoin(F.broadcast(ends)).select(*(c for c in df.columns if c not in cols), *(F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")).alias(c) for c in cols))


def check_grids(grids: DataFrame, ref: str, tol: float = 1e-10) -> DataFrame:
    """For each grid what differs from the one named ref, as a comma list; empty if compatible."""
    r = grids.filter(F.col("name") == ref)
    both = grids.filter(F.col("name") != ref).crossJoin(F.broadcast(r.select(*(F.col(c).alias(f"r_{c}") for c in grids.columns))))
    exact = [F.when(F.col(c) != F.col(f"r_{c}"), c) for c in ("nrow", "ncol", "crs")]
    near = [F.when(F.abs(F.col(c) - F.col(f"r_{c}")) >= tol, c) for c in ("xmin", "ymax", "xres", "yres")]
    return both.select("name", F.concat_ws(",", *exact, *near).alias("differs"))


def mask(df: DataFrame, zone: DataFrame, inverse: bool = False, value: str | None = None, update=None) -> DataFrame:
    """Cells in zone (or outside); with value the cells stay, and value becomes update elsewhere."""
    if value is None:
        return df.join(zone.select("cell_id"), "cell_id", "left_anti" if inverse else "left_semi")
    flag = df.join(zone.select("cell_id", F.lit(True).alias("__in")).distinct(), "cell_id", "left")
    inside = F.col("__in").isNotNull()
    return flag.withColumn(value, F.when(~inside if inverse else inside, F.col(value)).otherwise(F.lit(update))).drop("__in")


def full_grid(spark, nrow: int, ncol: int) -> DataFrame:
    """All cells of a grid, made where they are used."""
    ids = spark.range(1, nrow * ncol + 1).withColumnRenamed("id", "cell_id")
    r, c = row_col(F.col("cell_id"), ncol)
    return ids.select("cell_id", r.alias("row"), c.alias("col"))


def extend(df: DataFrame, grid: DataFrame, values: list[str]) -> DataFrame:
    """Every cell of grid, NULL where df has none."""
    return grid.join(df.select("cell_id", *values), "cell_id", "left")


def bounding_box(df: DataFrame) -> DataFrame:
    return df.agg(F.min("row").alias("row_min"), F.max("row").alias("row_max"), F.min("col").alias("col_min"), F.max("col").alias("col_max"))


def with_xy(df: DataFrame, xmin: float, ymax: float, res: float) -> DataFrame:
    """Coordinates of cell centres."""
    return df.withColumns({"x": F.lit(xmin) + (F.col("col") - 0.5) * res, "y": F.lit(ymax) - (F.col("row") - 0.5) * res})


def coarser(df: DataFrame, factor: int, value: str, method: str) -> DataFrame:
    """(row, col) of blocks of factor x factor cells with near, modal, average, min, max, med, q1, q3 or sum of value.

    Modal ties go to the smaller value; near takes the cell next to the block's middle (towards the origin).
    """
    v, up = F.col(value), df.withColumns({"row": (F.floor((F.col("row") - 1) / factor) + 1).cast("int"), "col": (F.floor((F.col("col") - 1) / factor) + 1).cast("int"), "__r": F.pmod(F.col("row") - 1, F.lit(factor)), "__c": F.pmod(F.col("col") - 1, F.lit(factor))})
    if method == "modal":
        n = up.filter(v.isNotNull()).groupBy("row", "col", value).agg(F.count("*").alias("__n"))
        return n.groupBy("row", "col").agg(F.min_by(value, F.struct(-F.col("__n"), v)).alias("value"))
    if method == "near":
        mid = (factor - 1) // 2
        return up.filter((F.col("__r") == mid) & (F.col("__c") == mid)).select("row", "col", v.alias("value"))
    return up.groupBy("row", "col").agg(_BLOCK[method](v).alias("value"))


#: Statistics of a block's values.
_BLOCK = {"average": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "med": lambda v: F.percentile(v, F.lit(0.5)), "q1": lambda v: F.percentile(v, F.lit(0.25)), "q3": lambda v: F.percentile(v, F.lit(0.75))}


def coarser_stats(df: DataFrame, factor: int, value: str, methods: list[str]) -> DataFrame:
    """(row, col) of blocks of factor x factor cells with several of average, min, max, med, q1, q3 and sum of value, in one pass."""
    up = df.select((F.floor((F.col("row") - 1) / factor) + 1).cast("int").alias("row"), (F.floor((F.col("col") - 1) / factor) + 1).cast("int").alias("col"), F.col(value).alias("__v"))
    return up.groupBy("row", "col").agg(*(_BLOCK[m](F.col("__v")).alias(m) for m in methods))


def finer(df: DataFrame, factor: int, value: str, method: str = "near") -> DataFrame:
    """Blocks of factor x factor for each cell, by near or bilinear: four weighted corners, NULL if one is missing."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    kids = df.select("row", "col", F.col(value).alias("__v"), F.explode(steps).alias("i")).select("*", F.explode(steps).alias("j"))
    at = lambda c, k: ((F.col(c) - 1) * factor + F.col(k) + 1).cast("int")
    if method == "near":
        return kids.select(at("row", "i").alias("row"), at("col", "j").alias("col"), F.col("__v").alias("value"))
    # a cell gives its weight to every fine cell whose centre is less than one coarse cell away
    around = F.sequence(F.lit(-factor), F.lit(2 * factor - 1))
    wide = df.select("row", "col", F.col(value).alias("__v"), F.explode(around).alias("i")).select("*", F.explode(around).alias("j"))
    weight = lambda k: 1 - F.abs((F.col(k) + 0.5) / factor - 0.5)
    some = wide.filter((weight("i") > 1e-12) & (weight("j") > 1e-12)).select(at("row", "i").alias("row"), at("col", "j").alias("col"), (weight("i") * weight("j")).alias("w"), "__v")
    out = some.groupBy("row", "col").agg(F.sum(F.col("w") * F.col("__v")).alias("value"), F.sum("w").alias("w"))
    return out.filter("w > 1 - 1e-9").select("row", "col", "value")


def extract(cells: DataFrame, layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """cells with a value of each layer, NULL where it has none."""
    for name, (df, col) in layers.items():
        cells = cells.join(df.select("cell_id", F.col(col).alias(name)), "cell_id", "left")
    return cells


def region_view(df: DataFrame, region: int) -> DataFrame:
    """A region's cells with rows and columns counted from its bounding box."""
    own = df.filter(F.col("region") == region)
    return own.crossJoin(F.broadcast(bounding_box(own))).withColumns({"row": F.col("row") - F.col("row_min") + 1, "col": F.col("col") - F.col("col_min") + 1}).drop("row_min", "row_max", "col_min", "col_max")


def one_hot_masked(probs: DataFrame, cells: DataFrame, col: str) -> DataFrame:
    """Probabilities where the cell is of the from-class, 0 elsewhere."""
    return probs.join(cells.select("cell_id", F.col(col).alias("__now")), "cell_id").withColumn("p", F.when(F.col("__now") == F.col("from_v"), F.col("p")).otherwise(0.0)).drop("__now")
