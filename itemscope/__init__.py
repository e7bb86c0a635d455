"""itemscope: profile, clean, featurise and compress item/interaction tables on Spark.

Subpackages: ``sources`` (readers, writers, fixture roles), ``functions``
(scalar column rules), ``operators`` (DataFrame -> DataFrame operators),
``plans`` (registered queries and their SQL twins), ``streaming``
(incremental forms of the same operators).
"""

__version__ = "0.1.0"
