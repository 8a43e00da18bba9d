"""martflow: reusable Spark operators for building analytical marts."""

__version__ = "0.1.0"
