"""reelgap: a PySpark-native engine for building and querying a film box-office dataset."""

__version__ = "0.1.0"
