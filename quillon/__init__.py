"""quillon: a PySpark-native engine for territorial, election and web-page data."""
