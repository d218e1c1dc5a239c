"""framewise: detection and tracking analytics as Spark DataFrame operators."""

from .config import TrackerConfig  # noqa: F401
from .session import get_session  # noqa: F401
