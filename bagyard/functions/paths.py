"""Path expressions (P01, P02, F16, F17) — Column -> Column, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dataset_relative(bag_path) -> Column:
    """``data/a/b`` -> ``a/b`` (P01); anything not below ``data/`` stays as is."""
    return F.regexp_replace(_c(bag_path), r"^data/", "")


def bag_relative(dataset_path) -> Column:
    """``a/b`` -> ``data/a/b``."""
    return F.concat(F.lit("data/"), _c(dataset_path))


def file_name(path) -> Column:
    """Last path segment."""
    return F.substring_index(_c(path), "/", -1)


def parent_path(path) -> Column:
    """Parent path, null at top level."""
    p = _c(path)
    return F.when(F.instr(p, "/") > 0, F.regexp_extract(p, r"^(.*)/[^/]*$", 1))


def sdo_name(path) -> Column:
    """P02: '/' and '.' become '_', then one leading '_' is dropped."""
    return F.regexp_replace(F.translate(_c(path), "/.", "__"), r"^_", "")


def sdo_set_name(dataset_id) -> Column:
    """A dataset id as a directory name, ':' -> '_'."""
    return F.translate(_c(dataset_id), ":", "_")


def ancestor_paths(path) -> Column:
    """proper ancestor paths of a path, shallowest first.

    ``a/b/c`` -> [``a``, ``a/b``]; a top-level name has none.  ``sequence(1, 0)``
    would count down, hence the guard.
    """
    n = n_slashes(path)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: ancestor_at(path, i))).otherwise(F.array().cast("array<string>"))


def n_slashes(path) -> Column:
    """The number of proper ancestors of a path."""
    p = _c(path)
    return F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))


def ancestor_at(path, depth) -> Column:
    """The ancestor of a path that has ``depth`` segments."""
    return F.call_function("substring_index", _c(path), F.lit("/"), _c(depth))


def ancestor_depths(path) -> Column:
    """1 up to the depth of the parent, null at top level: exploded and given to :func:`ancestor_at`, the rows of
    :func:`ancestor_paths` without an array of texts per path (compiled, where a lambda function is interpreted)."""
    n = n_slashes(path)
    return F.when(n > 0, F.sequence(F.lit(1), n))


def path_depth(path) -> Column:
    return F.size(F.split(_c(path), "/"))
