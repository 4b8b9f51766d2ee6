"""Spark-native outcome studies on record tables and image volumes."""
