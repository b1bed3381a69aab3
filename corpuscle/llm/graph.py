"""Connected components of a link table."""

from ..operators.graph import components

__all__ = ["components"]
