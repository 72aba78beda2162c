"""Access rights (P14, P15, P16) and the category dimension used by J06."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bagyard import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_rights(c) -> Column:
    """Exact, case-sensitive match on the five rights, else null."""
    return F.when(_c(c).isin(*K.FILE_RIGHTS), _c(c))


def category_rights_map() -> Column:
    """The access-category map as a literal map column (8 entries, broadcast-free)."""
    kv = []
    for cat, right in K.ACCESS_CATEGORY_RIGHTS:
        kv += [F.lit(cat), F.lit(right)]
    return F.create_map(*kv)


def category_dimension(spark: SparkSession) -> DataFrame:
    """The same map as a tiny dimension table (access_category, default_accessible)."""
    return spark.createDataFrame(K.ACCESS_CATEGORY_RIGHTS, "access_category string, default_accessible string")


def effective_accessible(access_rights, accessible_to_rights, category_default) -> Column:
    """Parse *after* the element coalesce.

    ``accessRights`` wins over ``accessibleToRights`` when present even if it is
    invalid; an invalid value then falls back to the dataset default, never to
    ``accessibleToRights``.
    """
    return F.coalesce(parse_rights(F.coalesce(_c(access_rights), _c(accessible_to_rights))), _c(category_default))


def effective_visible(visible_to_rights) -> Column:
    """Parsed ``visibleToRights`` else always ANONYMOUS."""
    return F.coalesce(parse_rights(_c(visible_to_rights)), F.lit(K.DEFAULT_VISIBLE_TO))
