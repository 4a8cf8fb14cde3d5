"""Training-data operators: one module per operator, registered in ``lorry.llm.registry``.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are shipped by value, so executors need only the public
libraries (numpy, pyarrow, regex), not an installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
