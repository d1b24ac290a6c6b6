"""Writers. Every one replaces the output if it is there."""

from .text import (
    centroid_lines,
    top_term_lines,
    vector_lines,
    write_iterations,
    write_lines,
    write_pairs,
    write_triples,
)

__all__ = [
    "centroid_lines",
    "top_term_lines",
    "vector_lines",
    "write_iterations",
    "write_lines",
    "write_pairs",
    "write_triples",
]
