"""Training-data pipeline operators (quality, dedup, decontamination, PII, mixing, archives).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it can be imported.  Its functions are sent to executors by
value, so executors need pyspark, numpy, pyarrow and xxhash but not this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
