"""PySpark-native operators for scholarly-catalog analytics.

Every operator is ``f(df, ..., params) -> DataFrame`` (or ``Column -> Column``)
and runs no Spark action itself, apart from the sinks, the streaming writers
and the fuzzy anti join (which writes its title table once).
"""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value, so that these need no
# installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
