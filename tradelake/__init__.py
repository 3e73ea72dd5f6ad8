"""tradelake: Spark-native batch engine for trade / field-merchandising exports."""

__version__ = "0.1.0"
