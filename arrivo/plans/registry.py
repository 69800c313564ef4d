"""All driver queries and their SQL twins, collected from the query modules."""

from arrivo.plans import queries as _core  # noqa: F401  (modules register on import)
from arrivo.plans import queries_reports as _reports  # noqa: F401
from arrivo.plans import queries_sources as _sources  # noqa: F401
from arrivo.plans import queries_model as _model  # noqa: F401
from arrivo.plans import queries_evaluation as _evaluation  # noqa: F401
from arrivo.plans import queries_shaping as _shaping  # noqa: F401
from arrivo.plans import queries_extras as _extras  # noqa: F401
from arrivo.plans import queries_feeds as _feeds  # noqa: F401
from arrivo.plans.queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
