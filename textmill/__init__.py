"""textmill: document, record and embedding pipelines as Spark DataFrame jobs.

Every public operator is either ``Column -> Column`` (pure expression, runs
inside whole-stage codegen) or ``DataFrame -> DataFrame`` (a lazy plan that
Catalyst optimises).  Nothing here collects data to the driver except small,
bounded counters.
"""

__version__ = "0.1.0"
