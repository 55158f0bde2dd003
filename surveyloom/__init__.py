"""Survey-response analytics on Spark DataFrames.

``sources``    landed JSON exports, listings and definitions -> DataFrames
``functions``  column expressions (text, answers, column ids, name scores)
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole reports put together from the operators
"""
