"""A Spark-native engine for push-broom imaging-spectrometer data."""
