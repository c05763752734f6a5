"""Operators for preparing training text. Nothing else in the library imports this package.

Functions sent to tasks are pickled by value, so workers need no copy of the package.
"""

import importlib

from pyspark import cloudpickle

for _name in ("text", "graph", "warc", "secrets", "langid", "bpe", "jaccard", "mixture", "rules", "vectors", "templates",
              "lines", "search", "negatives", "licenses"):
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))
