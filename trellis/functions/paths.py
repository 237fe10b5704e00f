"""Path expressions (all JVM-side column functions).

A path is absolute when it starts with ``/``.  Its components are what
remains after the leading ``/``, split on ``/``, with trailing empty parts
dropped and inner ones kept; a bare ``/`` has one empty component and a path
of slashes only has none.  Examples::

    /static/A.txt/   -> [static, A.txt]
    /static//A.txt   -> [static, "", A.txt]
    /                -> [""]
    //               -> []

The canonical key of a component array is ``/`` before every component,
concatenated (empty string for no components).  Equal keys <=> equal arrays,
so joins on the key are joins on the tree node.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name of the root folder every file lives under.
ROOT_NAME = "static"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_absolute(path) -> Column:
    """path starts with ``/`` (NULL path -> false)."""
    return F.coalesce(_c(path).startswith("/"), F.lit(False))


def _rest(p: Column) -> Column:
    return F.substring(p, 2, 1 << 30)


def path_components(path) -> Column:
    """component array; NULL for a path that is not absolute."""
    p = _c(path)
    stripped = F.rtrim(_rest(p), F.lit("/"))
    return (F.when(~is_absolute(p), F.lit(None).cast("array<string>"))
            .when(p == "/", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, "/")))


def path_key(path) -> Column:
    """F3 straight from the path, without the component array: what
    ``path_canonical(path_components(path))`` gives.  The node functions
    below work on such keys with plain string operations."""
    p = _c(path)
    stripped = F.rtrim(_rest(p), F.lit("/"))
    return (F.when(~is_absolute(p), F.lit(None).cast("string"))
            .when(p == "/", F.lit("/"))
            .when(stripped == "", F.lit(""))
            .otherwise(F.concat(F.lit("/"), stripped)))


def key_depth(key) -> Column:
    """Components of a key: its slashes."""
    k = _c(key)
    return F.length(k) - F.length(F.replace(k, F.lit("/"), F.lit("")))


def key_prefix(key, n) -> Column:
    """Key of the first ``n`` components; ``n`` is a column or a number."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.call_function("substring_index", _c(key), F.lit("/"), (n + 1).cast("int"))


def key_name(key) -> Column:
    """Last component of a key."""
    return F.substring_index(_c(key), "/", -1)


def key_parent(key) -> Column:
    """Key of the folder that holds the node."""
    return key_prefix(key, key_depth(key) - 1)


def key_under_root(key, root: str = ROOT_NAME) -> Column:
    """Whether a key is the root or below it (NULL key -> false)."""
    k = _c(key)
    return F.coalesce((k == F.lit("/" + root)) | k.startswith("/" + root + "/"), F.lit(False))


def key_prefix_lengths(key, shortest: int = 1) -> Column:
    """``[shortest .. depth-1]``, empty when the path is too short."""
    d = key_depth(key)
    return F.when(d - 1 >= shortest, F.sequence(F.lit(shortest), d - 1)).otherwise(F.array().cast("array<int>"))


def path_canonical(components) -> Column:
    """``/`` before every component, concatenated; ``""`` for none."""
    c = _c(components)
    return F.when(F.size(c) == 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(c, "/")))



def path_part(components, n: int) -> Column:
    """component ``n`` (0-based), NULL when out of range."""
    return F.get(_c(components), n)


def path_depth(components) -> Column:
    """number of components."""
    return F.size(_c(components))


def under_root(components, root: str = ROOT_NAME) -> Column:
    """at least one component and the first equals the root name."""
    c = _c(components)
    return F.coalesce((F.size(c) > 0) & (F.get(c, 0) == F.lit(root)), F.lit(False))
