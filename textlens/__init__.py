"""textlens: explainable Naive Bayes text classification as Spark DataFrame operators."""

__version__ = "0.1.0"
