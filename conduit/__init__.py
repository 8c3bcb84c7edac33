"""conduit: moving, shaping and watching data with plain Spark DataFrames."""

from conduit.session import release_scratch, shared_folder, tune

__all__ = ["release_scratch", "shared_folder", "tune"]
