"""nomograph: Spark-first analytics over a graph of legal works, plus corpus tools."""

__version__ = "0.1.0"
