"""Period-close analytics as Spark DataFrame operators."""

from closeworks.config import CloseConfig, DEFAULT_CONFIG

__all__ = ["CloseConfig", "DEFAULT_CONFIG"]
