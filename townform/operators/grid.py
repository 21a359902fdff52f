"""Bounding-box join as an equi-join on the cells of grids of several sizes.

A join on four inequalities would run as a nested loop. Every box is therefore listed under the grid cells
it covers and the sides meet on equal cells. Cells of level k are ``size * 2 ** k`` wide. A box belongs to
the first level whose cells are at least as wide as it is, so it covers four cells there at most, however
large it is. It is listed there if the other side has boxes of that level or a finer one, and at
the coarser levels that boxes of the other side belong to, as a pair
meets at the coarser of its two levels: one wide site among many houses costs each house a few rows, not
the site thousands of cells. A pair sharing several cells is kept only in the cell of the lower-left corner
of the boxes' overlap, so no ``distinct`` is needed. Rows spread over cells, not over zones, so a zone
holding most rows stays parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townform.functions.geometry import boxes_meet

Levels = Sequence[int]


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size)


def _level(box: Column, size: float) -> Column:
    wide = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    return F.when(wide > size, F.ceil(F.log2(wide / size))).otherwise(0).cast("int")


def _width(level: Column, size: float) -> Column:
    return F.lit(size) * F.pow(F.lit(2.0), level)


def grid_levels(df: DataFrame, box: str, size: float) -> list[int]:
    """Levels of the boxes that are there: one row of at most a few numbers, as levels double."""
    return sorted(df.agg(F.collect_set(_level(F.col(box), size))).first()[0]) or [0]


def by_cell(df: DataFrame, box: str, size: float, own: Levels = (0,), other: Levels = (0,)) -> DataFrame:
    """One row per listed cell of the ``box`` column, for joins of boxes of the levels ``own`` and ``other``.

    Where both are only level 0, every box is listed there, whatever its size.
    """
    b = F.col(box)
    if list(own) == list(other) == [0]:
        df = df.withColumn("cell_level", F.lit(0))
    else:
        level = _level(b, size)
        listed = F.array(*[F.lit(k) for k in sorted({*own, *other})])
        df = df.withColumn("cell_level", F.explode(F.filter(
            listed, lambda k: ((k == level) & (k >= min(other))) | ((k > level) & k.isin(list(other))))))
    width = _width(F.col("cell_level"), size)
    return (df
            .withColumn("cell_x", F.explode(F.sequence(_cell(b["xmin"], width), _cell(b["xmax"], width))))
            .withColumn("cell_y", F.explode(F.sequence(_cell(b["ymin"], width), _cell(b["ymax"], width)))))


def grid_join(left: DataFrame, right: DataFrame, left_box: str, right_box: str, size: float,
              keys: Sequence[str] = ("id_zone",), condition: Column | None = None,
              levels: tuple[Levels, Levels] | None = None) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose boxes meet, each exactly once.

    Apart from ``keys`` the two sides must have different column names. ``levels`` are those of both sides;
    without them they are looked up. ``([0], [0])`` suits boxes known to be about as small as a cell.
    """
    of_left, of_right = levels or (grid_levels(left, left_box, size), grid_levels(right, right_box, size))
    a = by_cell(left, left_box, size, of_left, of_right)
    b = by_cell(right, right_box, size, of_right, of_left)
    a_box, b_box = F.col(left_box), F.col(right_box)
    width = _width(F.col("cell_level"), size)
    meets = (boxes_meet(a_box, b_box)
             & (F.col("cell_x") == _cell(F.greatest(a_box["xmin"], b_box["xmin"]), width))
             & (F.col("cell_y") == _cell(F.greatest(a_box["ymin"], b_box["ymin"]), width)))
    if list(of_left) != [0] or list(of_right) != [0]:
        meets = meets & (F.col("cell_level") == F.greatest(_level(a_box, size), _level(b_box, size)))
    if condition is not None:
        meets = meets & condition
    return a.join(b, [*keys, "cell_level", "cell_x", "cell_y"]).where(meets).drop("cell_level", "cell_x", "cell_y")
