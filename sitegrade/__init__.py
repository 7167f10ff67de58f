"""Site-evidence analytics on Spark: contacts, density, conditions, scores."""

__version__ = "0.1.0"
