"""Sources and sinks: schemas, readers/writers, and domain views of the driver tables."""

from .io import read_source, write_tables  # noqa: F401
from .schemas import SCHEMAS  # noqa: F401
