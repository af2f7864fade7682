"""Column expressions over delimiter-encoded paths such as ``\\A\\B\\C\\``.

A path starts and ends with the separator and has no empty parts (``collapse``
makes it so); the expressions below then only count and cut, inside generated
code.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\\"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c: Column | str, sep: str) -> Column:
    """Split on a literal delimiter, keeping empty parts."""
    return F.split(_col(c), re.escape(sep))


def nth(c: Column | str, n: int | Column, sep: str = SEP) -> Column:
    """The n-th (1-based) delimited part, null when there is none."""
    index = n - 1 if isinstance(n, Column) else F.lit(n - 1)
    return F.get(split_list(c, sep), index)


def instr(c: Column | str, sub: str, start: int = 1, occurrence: int = 1) -> Column:
    """Position of the k-th occurrence from ``start``; a negative start searches backward.

    Occurrences may overlap; 0 when there is none.
    """
    c = _col(c)
    text, piece, at = (c, sub, F.lit(start)) if start > 0 else (F.reverse(c), sub[::-1], F.lit(-start))
    for k in range(occurrence):
        # a missing occurrence is a null start, for which locate gives 0
        at = F.call_function("locate", F.lit(piece), text, at if k == 0 else F.nullif(at, F.lit(0)) + 1)
    place = at if start > 0 else F.when(at > 0, F.length(c) - at - len(sub) + 2).otherwise(0)
    return F.when(c.isNotNull(), place)


def separators(path: Column | str, sep: str = SEP) -> Column:
    """How often the separator occurs."""
    path = _col(path)
    return F.floor((F.length(path) - F.length(F.replace(path, F.lit(sep), F.lit("")))) / len(sep)).cast("int")


def first_parts(path: Column, n: Column, sep: str = SEP) -> Column:
    """The path of the first ``n`` parts."""
    return F.concat(F.call_function("substring_index", path, F.lit(sep), (n + 1).cast("int")), F.lit(sep))


def depth(path: Column | str, sep: str = SEP) -> Column:
    return separators(path, sep) - 1


def level(path: Column | str, root_level: int = 0, sep: str = SEP) -> Column:
    """Tree level: separators - 2 + the level of the root node."""
    return separators(path, sep) - 2 + root_level


def leaf_name(path: Column | str, sep: str = SEP) -> Column:
    return F.substring_index(F.substring_index(_col(path), sep, -2), sep, 1)


def build(*columns: Column | str, sep: str = SEP) -> Column:
    """``\\a\\b\\c\\`` from columns."""
    return F.concat(F.lit(sep), *[F.concat(_col(c), F.lit(sep)) for c in columns])


def parent(path: Column | str, sep: str = SEP) -> Column:
    """The path one level up; null for a root node."""
    path = _col(path)
    n = depth(path, sep)
    return F.when(n > 1, first_parts(path, n - 1, sep))


def ancestors(path: Column | str, sep: str = SEP, with_self: bool = True) -> Column:
    """Array of every prefix path from the root down."""
    path = _col(path)
    last = depth(path, sep) if with_self else depth(path, sep) - 1
    prefixes = F.transform(F.sequence(F.lit(1), last), lambda i: first_parts(path, i, sep))
    return F.when(last >= 1, prefixes).otherwise(F.array().cast("array<string>"))


def collapse(path: Column | str, sep: str = SEP) -> Column:
    """Collapse runs of the separator to one."""
    return F.regexp_replace(_col(path), F.lit(f"({re.escape(sep)}){{2,}}"), F.lit(sep.replace("\\", "\\\\")))


def under(path: Column | str, prefix: str) -> Column:
    """True for the node itself and everything below it (literal prefix, no wildcards)."""
    return F.startswith(_col(path), F.lit(prefix))


def overlay_char(c: Column | str, position: int, char: str) -> Column:
    """Replace one character of a flag string."""
    return F.overlay(_col(c), F.lit(char), F.lit(position), F.lit(1))
