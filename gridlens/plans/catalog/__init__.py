"""The query catalogue: every registered operator with its DuckDB SQL twin.

Each entry builds a DataFrame from the driver tables at ``sf_dir`` (through the
fixture adapters) and names its columns exactly as the SQL twin does.  Output
conventions shared with the twins: timestamps as UTC ISO text, dates as
``yyyy-MM-dd`` text, integers as BIGINT, and floating values either exact by
construction (integer-unit sums, identical IEEE expressions) or rounded with the
Python-equal helpers where summation order differs across engines.

One module per area; importing this package registers every query.
"""

from gridlens.plans.catalog import curve, dashboard, dispatch, forecast, ingest, scenarios  # noqa: F401
from gridlens.plans.catalog.base import REGISTRY, Query, register

__all__ = ["REGISTRY", "Query", "register"]
