"""Column -> Column feature functions (dates, scalars, binning)."""

from .binning import *  # noqa: F401,F403
from .dates import *  # noqa: F401,F403
from .scalars import *  # noqa: F401,F403
