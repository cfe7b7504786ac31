"""sluice: a PySpark-native engine for curating large multimodal datasets."""
