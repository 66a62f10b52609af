"""Table specifications: what a wire column means and how it is stored."""

from rowtide.catalog.spec import FieldSpec, TableSpec, load_specs

__all__ = ["FieldSpec", "TableSpec", "load_specs"]
