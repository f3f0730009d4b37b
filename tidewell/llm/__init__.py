"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Its Python helpers run
inside Spark tasks, so the subpackage is pickled by value: executors need
numpy, pyarrow and the tokenizer libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def load_all():
    """Import every module that registers queries; returns (queries, oracles)."""
    from tidewell.llm import registered
    return registered.QUERIES, registered.ORACLES
