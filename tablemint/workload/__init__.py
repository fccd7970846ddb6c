"""The query catalogue."""

from . import scalars  # noqa: F401
from . import entities  # noqa: F401
from . import linking  # noqa: F401
from . import checks  # noqa: F401
from . import nested  # noqa: F401
from . import deliveries  # noqa: F401
from . import reports  # noqa: F401
from . import records  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
