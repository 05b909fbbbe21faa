"""Operators for preparing training text at scale: language, URL rules,
near-duplicates, fingerprints, licences, repeated substrings, token counts,
benchmark leaks, mixing, sharding, audits of filters and sources, byte-level BPE.  Nothing else in the library imports
this subpackage.

Functions that run in Python workers are sent with their code, so executors
need numpy, pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
