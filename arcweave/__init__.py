"""Graph traversal and integer matrix work on Spark DataFrames."""

from arcweave.scratch import Scratch
from arcweave.session import configure

__all__ = ["Scratch", "configure"]
