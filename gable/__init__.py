"""gable: Spark-native listing-feature and price-regression engine.

Every public operator is a pure ``DataFrame -> DataFrame`` function (use it
with ``df.transform``) or an estimator whose ``fit`` returns a model holding
small fitted-parameter DataFrames. Nothing in the data path is a Python UDF.

Layout
------
``functions``  column expressions (string cleaning, code maps, sentinels)
``operators``  DataFrame operators (projection, encoding, quality, joins,
               fitting, splits, metrics)
``sources``    readers / writers for the raw CSV inputs and stage outputs
``plans``      the composed stages (stage 1, 2, 2.5, 3, full runner, export)
``ml``         MLlib jobs (CV, search, feature elimination, scoring)
``streaming``  the stateless stages applied to a streaming source
"""

from gable.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
