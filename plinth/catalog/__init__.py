"""The query catalog: importing it registers every query."""

from plinth.catalog import (  # noqa: F401
    q_aggregates,
    q_files,
    q_geometry,
    q_joins,
    q_rows,
    q_streams,
    q_voxels,
    q_windows,
)
from plinth.catalog.registry import REGISTRY  # noqa: F401
