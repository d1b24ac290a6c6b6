"""Corpus to clusters on Spark: term counting, TF-IDF and cosine K-means.

Every operator takes DataFrames and returns DataFrames; see the sub-packages
``sources``, ``functions``, ``operators``, ``sinks`` and ``plans``.
"""

__version__ = "0.1.0"
