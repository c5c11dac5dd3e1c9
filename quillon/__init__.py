"""quillon: episodic sequence data and query operators as PySpark DataFrame plans."""

__version__ = "0.1.0"
