"""Text to token statistics, skip-gram embeddings and nearest neighbours, as Spark jobs."""

from vecloom.params import Params

__all__ = ["Params"]
