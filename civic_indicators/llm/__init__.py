"""Training-data operators (dedup, decontamination, scoring, extraction, mixing).

Self-contained: it may import the library's general helpers, and nothing in
the library imports it.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
