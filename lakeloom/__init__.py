"""lakeloom: a DataFrame-first analytics library on Apache Spark."""

__version__ = "0.1.0"
