"""The operators' way to send this library to the executors."""

from ..shipping import ship

__all__ = ["ship"]
