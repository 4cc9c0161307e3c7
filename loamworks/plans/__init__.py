"""Registered queries: operators applied to whole tables, each with its DuckDB twin."""

from loamworks.plans import graphs as _graphs
from loamworks.plans import grids as _grids
from loamworks.plans import learning as _learning
from loamworks.plans import reports as _reports
from loamworks.plans import scores as _scores
from loamworks.plans import tables as _tables
from loamworks.plans.registry import ORACLES, QUERIES, on_thin_grid

on_thin_grid(
    *"F1_focal_statistics F2_focal_extremes F3_tpi F4_slope_position F6_slope_aspect F6_gradient_slope F7_curvature F7_ruggedness F8_convergence F8_relative_position F9_distance F9_distance_cut F10_gaussian_density F11_fill_gaps".split(),
    *"F18_open F18_close F18_gradient F19_majority_filter F20_generalise F20_boundary_clean F21_rule_repair F24_texture F27_alluvial F30_low_pass J16_height_above_drainage".split(),
    *"G1_regions G1_regions_eight G2_adjacency G8_buffer G9_close_and_clean H1_flow_direction H2_flow_accumulation H4_basins H4_channel_relief".split(),
)

__all__ = ["ORACLES", "QUERIES"]
