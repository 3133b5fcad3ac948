"""pageprism: DataFrame operators for archived web-shop pages."""

__version__ = "0.1.0"
