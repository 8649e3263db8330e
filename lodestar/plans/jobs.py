"""Jobs: three landed sources -> JOB records (keyword + freshness gated) -> union.

No shuffle: every step is a per-row projection or filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodestar.operators.records import job_records_a, job_records_b, job_records_c
from lodestar.sources.payloads import JOB_A_FIELDS, JOB_C_FIELDS, json_data_rows, json_mixed_rows, rss_items


def jobs_from_sources(list_a: DataFrame | None, feed_b: DataFrame | None, obj_c: DataFrame | None,
                      as_of, keywords=None) -> DataFrame:
    """Each argument is a landed payload table ``(payload)``; a missing or
    failed source contributes no rows."""
    parts = []
    if list_a is not None:
        parts.append(job_records_a(json_mixed_rows(list_a, JOB_A_FIELDS), as_of, keywords=keywords))
    if feed_b is not None:
        parts.append(job_records_b(rss_items(feed_b), as_of, keywords=keywords))
    if obj_c is not None:
        parts.append(job_records_c(json_data_rows(obj_c, JOB_C_FIELDS), as_of, keywords=keywords))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
