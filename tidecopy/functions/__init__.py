"""Scalar helpers: run-date arithmetic, chunk grids, cell rules, geometry."""

from tidecopy.functions.cells import iso_text, null_cells, text_cells
from tidecopy.functions.geometry import geometry_srid, geometry_text
from tidecopy.functions.timeparts import (
    chunk_start,
    count_cutoff,
    lookback_start,
    parse_freq,
    typed_lit,
)

__all__ = [
    "null_cells", "text_cells", "iso_text", "chunk_start", "count_cutoff",
    "geometry_srid", "geometry_text",
    "lookback_start", "parse_freq", "typed_lit",
]
