"""Connected components, as the rest of the library has them."""

from __future__ import annotations

from ..operators.components import connected_components
from ..session import release

__all__ = ["connected_components", "release"]
