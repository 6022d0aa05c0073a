"""springfloor: a PySpark-native engine for competition-results analytics."""
