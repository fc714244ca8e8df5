"""All registered queries."""

from supplyloom.queries import aggregating, joining, picking, projections, reports, scalars, storing  # noqa: F401
from supplyloom.queries.registry import QUERIES, SQL  # noqa: F401
