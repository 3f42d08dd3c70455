"""tripfold: trip-fact analytics on Spark DataFrames.

Reads a trip fact and a place dimension, applies named data-quality rules,
derives hour / duration / tip %, and answers demand, revenue and tipping
questions through mergeable partial aggregates.
"""

__version__ = "0.1.0"
