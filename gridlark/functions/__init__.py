"""Column functions; see ``formula`` for the three ways each of them runs."""

from .cells import (
    s2_area_m2,
    s2_cell_id,
    s2_cell_level,
    s2_cell_to_hex,
    s2_cell_vertex,
    s2_contains,
    s2_distance_meters,
    s2_edge_neighbor,
    s2_hex_to_cell,
    s2_parent,
    s2_to_geo,
)
from .unions import (
    s2_cell_union_area,
    s2_cell_union_contains,
    s2_cell_union_intersects,
    s2_cell_union_of,
    s2_cell_union_pack,
    s2_cell_union_unpack,
)
from .wkt import s2_cell_id_from_point

ALL = (
    s2_cell_id,
    s2_contains,
    s2_distance_meters,
    s2_area_m2,
    s2_parent,
    s2_cell_level,
    s2_to_geo,
    s2_cell_to_hex,
    s2_hex_to_cell,
    s2_cell_vertex,
    s2_cell_id_from_point,
    s2_edge_neighbor,
    s2_cell_union_pack,
    s2_cell_union_contains,
    s2_cell_union_intersects,
    s2_cell_union_area,
    s2_cell_union_of,
    s2_cell_union_unpack,
)
