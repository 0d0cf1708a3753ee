"""corpuslake: keep a website-derived text corpus current with Spark.

Sitemap snapshots -> change feed -> page text -> chunks -> BM25 and dense
vectors -> keyed document tables.  Everything public takes and returns
``DataFrame`` or ``Column``; see README.md for the map of modules.
"""

import sys

from pyspark import cloudpickle

# The few Python helpers that run inside tasks (HTML text, chunk spans, the
# embedder) travel with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
