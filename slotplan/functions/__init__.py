"""Column functions: every one returns a native Spark ``Column`` (no Python UDFs)."""

from .text import *  # noqa: F401,F403
from .fmt import *  # noqa: F401,F403
