"""Reports that follow a stream."""

from .latest import follow_versions

__all__ = ["follow_versions"]
