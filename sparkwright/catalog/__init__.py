"""All registered queries.  Importing this package fills ``REGISTRY``."""

from .registry import REGISTRY, Entry, query  # noqa: F401
from . import (weather_jobs, relational, rows_and_order, io_formats,  # noqa: F401
               text_and_logs, pipelines, layouts)
