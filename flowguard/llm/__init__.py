"""Training-data operators: token counts, mixing, licences, sharding, quality, language-model scores, web captures,
benchmark overlap, quality rules and near-duplicates.

Functions that run in Python workers travel by value, so executors need no copy of this package.
"""

from pyspark import cloudpickle as _cloudpickle

import flowguard.llm as _this

_cloudpickle.register_pickle_by_value(_this)
