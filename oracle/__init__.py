"""DuckDB SQL that states each query independently, in plain join-and-aggregate form."""

from .ctes import AS_OF
from .jobs import job_sql
from .listings import listing_sql
from .quality import quality_sql
from .reports import report_sql


def all_sql() -> dict[str, str]:
    return {**report_sql(AS_OF), **listing_sql(AS_OF), **job_sql(), **quality_sql(AS_OF)}
