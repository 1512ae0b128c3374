"""Map tiles with halos: each tile's task gets its cells and the strips of its neighbours that its stencils reach.

A cell goes to its own tile, and only cells within the halo of a border also go to the tiles across it. With tiles of side t
and a halo h that is (1 + 2 * h / t) ** 2 rows a cell at most, whatever the stencil. Inside a tile a stencil is a sum or
maximum of shifted arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Side of a tile; with wide halos tiles are at least HALO_FACTOR halos wide.
TILE, HALO_FACTOR = 256, 8


def tile_side(halo: int) -> int:
    return max(TILE, HALO_FACTOR * halo)


class Patch:
    """A tile's arrays: own cells in the middle, halo around; missing cells are NaN (numbers) or absent from there."""

    def __init__(self, rows: pd.DataFrame, side: int, halo: int, tile_row: int, tile_col: int):
        self.halo, self.side, self.rows = halo, side, rows
        self.r = rows["row"].to_numpy() - tile_row * side + halo
        self.c = rows["col"].to_numpy() - tile_col * side + halo
        inner = (self.r >= halo) & (self.r < halo + side) & (self.c >= halo) & (self.c < halo + side)
        self.own = rows[inner]
        self.at = self.r[inner], self.c[inner]

    def grid(self, values: np.ndarray, blank, dtype=np.float64) -> np.ndarray:
        out = np.full((self.side + 2 * self.halo,) * 2, blank, dtype)
        out[self.r, self.c] = values
        return out

    def shifted(self, grid: np.ndarray, dr: int, dc: int) -> np.ndarray:
        """What lies dr rows and dc columns from each own cell."""
        return grid[self.at[0] + dr, self.at[1] + dc]

    def moved(self, grid: np.ndarray, dr: int, dc: int) -> np.ndarray:
        """The tile's middle, moved: [r, c] is what lies dr rows and dc columns from the tile's cell (r, c)."""
        a, b = self.halo + dr, self.halo + dc
        return grid[a : a + self.side, b : b + self.side]

    def middle(self, values: np.ndarray) -> np.ndarray:
        """Values of own cells out of an array of the tile's middle."""
        return values[self.at[0] - self.halo, self.at[1] - self.halo]


def on_tiles(cells: DataFrame, halo: int, work: Callable[[Patch], Iterator[pd.DataFrame] | list[pd.DataFrame]], schema: str) -> DataFrame:
    """work on every tile of cells (row, col and what else it needs), its frames put together; schema of the result."""
    side = tile_side(halo)
    row, col = F.col("row"), F.col("col")
    # where a cell belongs, and the tiles across the borders it is near to
    reach = lambda c: F.array_distinct(F.array(*(F.floor((c + d) / side).cast("int") for d in (0, -halo, halo))))
    sent = cells.withColumn("__tr", F.explode(reach(row))).withColumn("__tc", F.explode(reach(col)))
    names = [p.strip().split(" ")[0].strip("`") for p in schema.split(",")]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        patch = Patch(rows, side, halo, int(key[0]), int(key[1]))
        out = [x for x in work(patch) if len(x)] if len(patch.own) else []
        return pd.concat(out)[names] if out else pd.DataFrame(columns=names)

    return sent.groupBy("__tr", "__tc").applyInPandas(run, schema)
