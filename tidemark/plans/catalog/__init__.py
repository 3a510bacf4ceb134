"""Every operator as a query over the given tables, with the SQL that must agree.

The tables stand in for the CRM feeds: customers for accounts and contacts,
orders for opportunities, line items for tasks and history (their key
``l_orderkey, l_linenumber`` repeats), suppliers for users, events for pushed
changes and config rows, parts for custom fields, nations for tenants.
"""

from tidemark.plans.catalog import (  # noqa: F401  (each module registers its queries)
    custom,
    extracts,
    flows,
    pushes,
    records,
    scalars,
    streams,
    upserts,
)
from tidemark.plans.catalog.registry import CATALOG

__all__ = ["CATALOG"]
