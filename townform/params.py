"""Constants of the indicator definitions and the few tuning knobs of the joins."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Fixed values of the indicator definitions.
    default_height: float = 3.0      # height of a building whose height is unknown or 0
    default_levels: int = 1          # levels of a building recorded with 0
    epsilon: float = 0.005           # neighbours closer than this count as joined
    passive_depth: float = 6.005     # depth lit from a free wall (6 m + epsilon)
    road_margin: float = 3.0         # added to the road width
    block_buffer: float = 0.01       # footprints grown by this dissolve into blocks
    iris_grow: float = 0.0001        # units and districts are grown by this before they are overlaid
    min_width: float = 0.1           # thinner shapes have no main direction
    srid: int = 2154                 # metric reference system of block outlines
    forest_seed: int = 7

    # Numerical tolerance: coordinates closer than this are the same place.
    snap: float = 1e-6

    # Join tuning; results do not depend on these.
    building_cell: float = 25.0      # grid cell of footprint joins, about twice a footprint
    road_cell: float = 25.0          # grid cell of wall-to-road joins
    unit_cell: float = 500.0         # grid cell of unit-to-district joins
    tile: int = 128                  # buildings per tile of the distance job

    integer_degrees: bool = False    # whole degrees for main directions
