from fieldnotes.functions.cells import (
    binary_label,
    category_cell,
    finite_or_zero,
    id_cell,
    id_number,
    numeric_cell,
    rounded,
)
from fieldnotes.functions.hashing import uniform

__all__ = [
    "binary_label", "category_cell", "finite_or_zero", "id_cell", "id_number",
    "numeric_cell", "rounded", "uniform",
]
