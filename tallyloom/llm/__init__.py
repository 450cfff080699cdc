"""Operators for preparing training text at cluster scale.

One module per operator, ``queries.py`` with the registered queries and
``sql.py`` with their DuckDB SQL. Nothing else in the library imports this
package.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
