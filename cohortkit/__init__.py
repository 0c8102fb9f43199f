"""cohortkit: Spark-native preparation, exploration, modelling and
interpretation of event-level tables.

Every operator is a function ``DataFrame -> DataFrame`` (or a small tidy
metrics DataFrame) built on Spark SQL / Spark ML.  Only bounded metadata
(fill values, category lists, top-k names, model coefficients) ever reaches
the driver.
"""

from cohortkit.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
