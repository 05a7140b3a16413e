"""lectern: a PySpark-native engine for cleaning, checking and scoring
multilingual transcript text."""

__version__ = "0.1.0"
