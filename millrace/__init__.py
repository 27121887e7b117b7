"""millrace: a PySpark-native engine that turns forum pages into a clean, de-identified corpus."""
