"""Operators for preparing text corpora: duplicates, packing, filters, scans and extraction.

Python code that runs in tasks is sent along with them, so that executors need not have this
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
