"""A PySpark-native engine that turns streams of loosely structured agent events into analyst-ready tables."""
