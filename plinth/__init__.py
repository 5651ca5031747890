"""Spark-native operators for building and auditing 3D object-placement datasets."""
