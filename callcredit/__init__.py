"""Call attribution and incentive analytics on Spark."""

__version__ = "0.1.0"
