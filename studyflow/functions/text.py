"""Scalar cleaning rules for clinical text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in a curated file, the template
# tokens of category codes and the reserved labels of a column mapping.
NUMBER_PATTERN = r"^\s*([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[nN][aA][nN])\s*$"
DATALABEL = "DATALABEL"
VISITNAME = "VISITNAME"
RESERVED_LABELS = ["SUBJ_ID", "SITE_ID", "VISIT_NAME", "VISIT_DATE", "ENROLL_DATE", "OMIT", "DATA_LABEL"]
# end of fixed values


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def swap(c: Column | str, old: str, new: str) -> Column:
    """Literal replacement."""
    return F.replace(_col(c), F.lit(old), F.lit(new))


def has(c: Column | str, token: str) -> Column:
    return F.contains(_col(c), F.lit(token))


def strip(c: Column | str) -> Column:
    """Trim any leading and trailing white space, tabs and line ends included."""
    return F.btrim(_col(c), F.lit(" \t\r\n\f"))


def is_numeric(c: Column | str) -> Column:
    """True / false; null stays null."""
    return F.rlike(_col(c), F.lit(NUMBER_PATTERN))


def to_number(c: Column | str) -> Column:
    """The number, or null where the text is none."""
    c = _col(c)
    return F.when(is_numeric(c), strip(c).try_cast("double"))


def is_date(c: Column | str, fmt: str = "yyyyMMdd") -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.try_to_timestamp(c, F.lit(fmt)).isNotNull())


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def missing_to_null(c: Column | str, markers: tuple[str, ...] = (".", "NaN")) -> Column:
    """Null out the markers a vendor file uses for missing values."""
    c = strip(c)
    return F.when(~c.isin("", *markers), c)


def clean_column(c: Column | str) -> Column:
    """Trim, strip one pair of quotes, drop ``\\`` and ``*``, spell out ``%`` and ``&``."""
    bare = F.regexp_replace(strip(c), r'^"(.+)"$', "$1")
    plain = F.translate(bare, "\\*", "")
    return F.coalesce(swap(swap(plain, "%", "PCT"), "&", " and "), F.lit(""))


def category_path(c: Column | str) -> Column:
    """``_`` becomes a space and ``+`` a level separator."""
    return F.translate(_col(c), "_+", " \\")


def subject_key(study: Column | str, site: Column | str, subject: Column | str) -> Column:
    """``STUDY:site:subject`` with runs of colon pairs collapsed."""
    study = F.lit(study) if isinstance(study, str) else study
    joined = F.concat(study, F.lit(":"), F.coalesce(_col(site), F.lit("")), F.lit(":"), _col(subject))
    return F.regexp_replace(joined, "(::)+", ":")


def clean_pipes(c: Column | str) -> Column:
    """Edge pipes go, inner pipes become dashes."""
    return swap(F.btrim(_col(c), F.lit("|")), "|", "-")


def clean_label_pipes(c: Column | str) -> Column:
    return swap(c, "|", ",")


def drop_broken(c: Column | str, mine: str, other: str) -> Column:
    """Drop every ``mine`` where pairs are empty or ``mine`` has no ``other``."""
    c = _col(c)
    broken = has(c, "()") | has(c, "( )") | (has(c, mine) & ~has(c, other))
    return F.when(broken, swap(c, mine, "")).otherwise(c)


def clean_parens(c: Column | str) -> Column:
    """Both parentheses; the closing one sees the text left by the opening one."""
    return drop_broken(drop_broken(c, "(", ")"), ")", "(")


def words_for_symbols(c: Column | str, plus: bool = False, underscore: bool = False) -> Column:
    """``%`` and ``&`` (optionally ``+`` and ``_``) spelled out."""
    out = swap(swap(c, "%", " Pct"), "&", " and ")
    if plus:
        out = swap(out, "+", " and ")
    if underscore:
        out = swap(out, "_", " ")
    return out


def tidy_spaces(c: Column | str) -> Column:
    """One pass of double spaces and spaces before commas, trim, then trailing commas."""
    return F.rtrim(F.trim(swap(swap(c, "  ", " "), " ,", ",")), F.lit(","))


def insert_label_token(category: Column | str, position: Column | str) -> Column:
    """Put the label token before (A) or after (B) the last category part, unless present."""
    category = _col(category)
    before_last = F.regexp_replace(category, r"^(.+)\+([^+]+?)$", "$1+" + DATALABEL + "+$2")
    after = F.concat(category, F.lit("+" + DATALABEL))
    return F.when(has(category, DATALABEL), category).when(_col(position) == "A", before_last).otherwise(after)


def cut_after(c: Column | str, token: str, extra: int) -> Column:
    """Keep the text up to ``extra`` characters past the start of a token."""
    c = _col(c)
    return F.substring(c, F.lit(1), F.locate(token, c) + extra)
