class DataQualityError(Exception):
    """A data quality limit was exceeded."""


class QualityGateError(DataQualityError):
    """At least one validation suite failed."""


class EmptyDatasetError(DataQualityError):
    """A dataset, or one day of it, has no rows."""


class LoadError(Exception):
    """One or more tables of a control batch could not be loaded."""
