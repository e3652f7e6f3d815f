"""All registered queries (importing the modules fills the registry)."""

from . import generic_queries  # noqa: F401
from . import domain_queries  # noqa: F401
from . import report_queries  # noqa: F401
from . import ledger_queries  # noqa: F401
from . import gap_queries  # noqa: F401
from . import year_queries  # noqa: F401
from . import source_queries  # noqa: F401
from . import clean_queries  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
