"""Polygons as vertex tables, turned into cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def edges(vertices: DataFrame) -> DataFrame:
    """(poly_id, x1, y1, x2, y2) of closed rings."""
    w = Window.partitionBy("poly_id").orderBy("seq")
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(w))
    return vertices.select("poly_id", F.col("x").alias("x1"), F.col("y").alias("y1"), nxt("x").alias("x2"), nxt("y").alias("y2"))


#: Columns that a run is cut at, so that runs and cells meet by row and stretch of columns.
STRETCH = 256


def runs_of(vertices: DataFrame) -> DataFrame:
    """(poly_id, row, a, b): the columns a to b of a row whose cells' centres (col - 0.5, row - 0.5) lie inside.

    Scanlines: each edge meets the centre rows it spans, and crossings of a row pair up by x. A polygon's runs don't overlap.
    """
    e = edges(vertices)
    low, high = F.ceil(F.least("y1", "y2") + 0.5), F.ceil(F.greatest("y1", "y2") + 0.5) - 1
    crossing = e.filter((F.col("y1") != F.col("y2")) & (high >= low)).withColumn("row", F.explode(F.sequence(low, high)))
    x = F.col("x1") + (F.col("row") - 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    own = Window.partitionBy("poly_id", "row").orderBy("x")
    pairs = crossing.select("poly_id", "row", x.alias("x")).withColumns({"k": F.row_number().over(own), "x_to": F.lead("x").over(own)}).filter("k % 2 = 1 AND x_to IS NOT NULL")
    first, last = F.ceil(F.col("x") + 0.5), F.ceil(F.col("x_to") + 0.5) - 1
    return pairs.select("poly_id", F.col("row").cast("int").alias("row"), first.cast("int").alias("a"), last.cast("int").alias("b")).filter("b >= a")


def cells_of(runs: DataFrame, cells: DataFrame, key: str = "poly_id") -> DataFrame:
    """(key, cell_id) of the cells on runs. A run is a row for each stretch of columns it touches, never one for each cell."""
    at = lambda c: F.floor(c / STRETCH).cast("int")
    cut = runs.select(key, "row", "a", "b", F.explode(F.sequence(at(F.col("a")), at(F.col("b")))).alias("stretch"))
    own = cells.select("cell_id", "row", "col", at(F.col("col")).alias("stretch"))
    return own.join(cut, ["row", "stretch"]).filter("col BETWEEN a AND b").select(key, "cell_id")


def touched(vertices: DataFrame) -> DataFrame:
    """(poly_id, row, a, b) of the cells that edges run through, one a run: edges are cut where they cross lines of the
    grid, and each piece lies in the cell of its middle."""
    def cuts(c: str):
        a, b = F.col(f"{c}1"), F.col(f"{c}2")
        low, high = F.ceil(F.least(a, b)).cast("int"), F.floor(F.greatest(a, b)).cast("int")
        return F.when((a != b) & (low <= high), F.transform(F.sequence(low, high), lambda v: (v - a) / (b - a))).otherwise(F.array().cast("array<double>"))

    t = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts("x"), cuts("y")))
    pieces = edges(vertices).withColumn("t", t).withColumn("piece", F.explode(F.zip_with(F.slice("t", 1, F.size("t") - 1), F.slice("t", 2, F.size("t") - 1), lambda a, b: F.struct(((a + b) / 2).alias("mid"), (b - a).alias("size")))))
    at = lambda c: (F.floor(F.col(f"{c}1") + F.col("piece.mid") * (F.col(f"{c}2") - F.col(f"{c}1"))) + 1).cast("int")
    return pieces.filter("piece.size > 1e-9").select("poly_id", at("y").alias("row"), at("x").alias("a")).distinct().withColumn("b", F.col("a"))


def rasterize(vertices: DataFrame, cells: DataFrame, touches: bool = False) -> DataFrame:
    """(poly_id, cell_id): cells whose centre lies inside; touches adds those an edge runs through."""
    runs = runs_of(vertices)
    if touches:
        inside = runs.select("poly_id", "row", F.col("a").alias("__a"), F.col("b").alias("__b"))
        rim = touched(vertices)
        more = rim.join(inside, (rim["poly_id"] == inside["poly_id"]) & (rim["row"] == inside["row"]) & rim["a"].between(inside["__a"], inside["__b"]), "left_anti")
        runs = runs.unionByName(more)
    return cells_of(runs, cells)


def merged_runs(runs: DataFrame, attributes: DataFrame, group: str) -> DataFrame:
    """(group, row, a, b) of the cells on any run of a group's polygons: a sweep along each row joins runs that overlap or touch."""
    own = Window.partitionBy(group, "row").orderBy("a", "b")
    far = F.max("b").over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = runs.join(attributes.select("poly_id", group), "poly_id").withColumn("opens", F.coalesce(F.col("a") > far + 1, F.lit(True)).cast("int"))
    rows = rows.withColumn("no", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(group, "row", "no").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("no")


def field_of(covered: DataFrame, attributes: DataFrame, field: str) -> DataFrame:
    """A field by cell; where polygons overlap the last (greatest poly_id) wins."""
    return covered.join(attributes.select("poly_id", field), "poly_id").groupBy("cell_id").agg(F.max_by(field, "poly_id").alias(field))


def dissolve(vertices: DataFrame, cells: DataFrame, attributes: DataFrame, group: str) -> DataFrame:
    """(group, cell_id): cells covered by each group of polygons, once each; polygons are joined as runs, before any cell."""
    return cells_of(merged_runs(runs_of(vertices), attributes, group), cells, group)


def union_features(*layers: DataFrame) -> DataFrame:
    out = layers[0].withColumn("layer", F.lit(0))
    for k, one in enumerate(layers[1:], 1):
        out = out.unionByName(one.withColumn("layer", F.lit(k)), allowMissingColumns=True)
    return out


def overlaps(covered: DataFrame, zone: DataFrame) -> DataFrame:
    """For each polygon how many of its cells lie in the zone; 0 where none does."""
    flag = covered.join(zone.select("cell_id", F.lit(1).alias("z")), "cell_id", "left")
    return flag.groupBy("poly_id").agg(F.count("*").alias("n_cells"), F.count("z").alias("n_in_zone"))
