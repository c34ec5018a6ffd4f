"""maskloom: analytics for labelled image, mesh and motion corpora on PySpark."""

__version__ = "0.1.0"
