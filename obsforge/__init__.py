"""obsforge: observation-catalogue and image-reduction analytics on PySpark."""

__version__ = "0.1.0"
