"""crease — ball-by-ball cricket analytics as Spark DataFrame jobs.

Layers (each a plain function DataFrame -> DataFrame):

* ``crease.sources``   file scan, fingerprint, JSON parse/flatten, venues and seeds,
                       plus adapters that derive match data from the driver's tables
* ``crease.functions`` Column helpers (surrogate keys, rates, overs display, ...)
* ``crease.operators`` reusable DataFrame operators (distinct_on, running_count,
                       incremental upsert, data-quality tests)
* ``crease.plans``     the staging / intermediate / mart models, report queries and
                       the batch + incremental pipeline
* ``crease.streaming`` file-arrival stream driving the same pipeline via foreachBatch
"""

__version__ = "0.1.0"
