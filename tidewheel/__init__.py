"""tidewheel: a Spark-native business analytics engine.

A small semantic layer (typed star schemas, an explicit filter context and
composable measures) that compiles to ordinary DataFrame plans, with a library
of data-shaping transforms and the domain computations built on them.
"""
