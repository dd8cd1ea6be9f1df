"""Task, project and habit analytics as ordinary PySpark DataFrame functions."""

from tasklens.config import Settings

__all__ = ["Settings"]
