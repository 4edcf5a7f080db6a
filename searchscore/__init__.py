"""searchscore: search-relevance features for query-product pairs on PySpark.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark SQL expressions, so Catalyst plans, prunes and
codegens it. Sub-packages:

* ``sources``   - readers and writers, input schemas, derived test fixtures
* ``functions`` - Column-level text functions (tokenising, overlaps, lengths)
* ``operators`` - DataFrame operators (merge, TF-IDF, similarity joins,
                  stemming, sampling, metrics, models)
* ``plans``     - composed pipelines (preprocess, feature generation, full run)
* ``streaming`` - the stateless row-wise features applied to streaming input
"""

import sys

from pyspark import cloudpickle

# Functions of the package travel to the Python workers by value, so that
# executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
