"""quirework: scanned pages to corpus, excerpts and exports, as Spark DataFrame operators."""

__version__ = "0.1.0"
