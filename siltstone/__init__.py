"""A PySpark-native engine that refines text corpora for language-model training."""
