"""Resolution over records: STARTUP and PRODUCT names -> canonical names,
nested name fields updated in place, and the mapping log.

Shuffles per record type: distinct raw names, the fuzzy best-form
aggregate, and the join of the name map back to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import first_nonempty
from lodestar.operators.profile import frequency
from lodestar.operators.records import set_nested
from lodestar.operators.resolve import mapping_log, resolve


def resolve_records(startups: DataFrame | None, products: DataFrame | None, seed: DataFrame, **kw):
    """Returns (startups_resolved, products_resolved, mapping_log, method_counts)."""
    logs, outs = [], []
    for df, etype, raw_fields, target in ((startups, "STARTUP", ("rawName", "entityName"), "entityName"),
                                          (products, "PRODUCT", ("rawStartupName", "startupName"), "startupName")):
        if df is None:
            outs.append(None)
            continue
        r = df.withColumn("__name__", first_nonempty(*[F.col(f"content.{f}") for f in raw_fields]))
        r = resolve(r, "__name__", seed, **kw)
        logs.append(mapping_log(r, etype, "__name__", F.col("source.url")))
        outs.append(set_nested(r, f"content.{target}", F.col("canonical_name"))
                    .drop("__name__", "canonical_name", "method", "confidence"))
    log = logs[0]
    for x in logs[1:]:
        log = log.unionByName(x)
    return outs[0], outs[1], log, frequency(log, "method")
