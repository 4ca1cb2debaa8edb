"""Operators for preparing training text.  Nothing else in the library imports them.

Functions that run in tasks are sent by value, so executors do not need this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
