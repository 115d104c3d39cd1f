"""Source readers: JDBC, CSV (decimal comma), Parquet, folders of workbooks."""

from vellum.sources.readers import (
    bind_parameters,
    jdbc_url,
    month_predicates,
    overridden_source,
    override_source,
    preview,
    read_csv,
    read_jdbc,
    read_parquet,
    read_source,
    read_target,
)
from vellum.sources.workbooks import read_workbooks

__all__ = [
    "bind_parameters",
    "jdbc_url",
    "month_predicates",
    "overridden_source",
    "override_source",
    "preview",
    "read_csv",
    "read_jdbc",
    "read_parquet",
    "read_source",
    "read_target",
    "read_workbooks",
]
