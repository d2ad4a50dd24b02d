"""Parts of a web ACL resource name: ``<prefix>:<scope>/webacl/<name>/<id>``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def acl_part(arn: Column, position: int) -> Column:
    """Slash-separated part, NULL when the resource name has fewer than four."""
    parts = F.split(arn, "/")
    return F.when(F.size(parts) >= 4, F.get(parts, F.lit(position)))


def acl_scope_of(arn: Column) -> Column:
    """REGIONAL or CLOUDFRONT; REGIONAL where the first part says neither, NULL for a short name."""
    head = acl_part(arn, 0)
    return (
        F.when(head.isNull(), F.lit(None).cast("string"))
        .when(head.endswith(":global"), F.lit("CLOUDFRONT"))
        .otherwise(F.lit("REGIONAL"))
    )
