"""textmill: build and check sentence corpora as Spark DataFrame plans."""

__version__ = "0.1.0"
