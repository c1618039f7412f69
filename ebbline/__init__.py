"""Point-in-time churn analytics on Spark DataFrames."""

from ebbline.config import ChurnConfig

__all__ = ["ChurnConfig"]
