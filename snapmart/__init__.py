"""Spark-native building blocks for monthly customer snapshots.

``functions``  Column -> Column expressions (text, numbers, dates, labels)
``operators``  DataFrame -> DataFrame operators (cleaning, dedup, splits, metrics, ...)
``sources``    readers, partitioned layers and the model store
``plans``      compositions: gold snapshot, training, scoring, monitoring
``catalog``    fixture views, registered queries and their SQL oracles
"""
