"""Tabular preparation and binary-risk AutoML on Spark DataFrames.

``sources``    readers and writers
``functions``  column expressions (text, numeric, fuzzy matching, hashing)
``operators``  fit / apply operators over whole DataFrames
``plans``      composed flows: cleaner, transformer, preparation, AutoML
``streaming``  applying fitted row-wise models to streams
"""
