"""Column functions and small row-selection helpers shared by the operators."""

from clientpulse.functions.rows import latest_rows, newest_first, top_rows, total_order
from clientpulse.functions.scalars import *  # noqa: F401,F403

__all__ = [name for name in dir() if not name.startswith("_")]
