"""Every query of the library, by importing the modules that register them."""

from __future__ import annotations

from . import calibration, depth_maps, exports, files_rows, frame_models, geometry_rows, graph_rows, graphs, joins, maps, reductions, solver, stream_rows, transforms, windows  # noqa: F401
from .catalog import ORACLE_SQL, QUERIES  # noqa: F401

FLAGSHIP = "points_from_depth"
