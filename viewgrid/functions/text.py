"""Text standardisation column builders (all JVM-side built-ins).

The spellings reproduce the models' cleaning rules exactly; see SURVEY §2.10.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes of the cleaning rules.
BRAND_SEPARATORS = r"[\s,_/:;|.-]+"
TITLE_SEPARATORS = r"[\s'’,:.-]+"
CATEGORY_SEPARATORS = r"[\s,-]+"
# The ad-feed rules first delete this two-character sequence (apostrophe then
# right single quote); a lone apostrophe survives.
QUOTE_PAIR = "'’"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_hyphen(c) -> Column:
    """lower(replace(c, ' ', '-')): every space becomes one hyphen."""
    return F.lower(F.replace(_c(c), F.lit(" "), F.lit("-")))


def upper_hyphen(c) -> Column:
    return F.upper(F.replace(_c(c), F.lit(" "), F.lit("-")))


def lower_underscore(c) -> Column:
    return F.lower(F.replace(_c(c), F.lit(" "), F.lit("_")))


def brand(c, strip_apostrophes: bool = False) -> Column:
    """Brand / ad-title cleaning: drop the quote pair, collapse separator runs.

    ``strip_apostrophes=True`` applies the documented intent (remove every
    apostrophe) instead of the literal rule.
    """
    x = _c(c)
    if strip_apostrophes:
        x = F.regexp_replace(x, "['’]", "")
    else:
        x = F.replace(x, F.lit(QUOTE_PAIR), F.lit(""))
    return F.lower(F.regexp_replace(x, BRAND_SEPARATORS, "-"))


def title(c) -> Column:
    """Program-title cleaning: runs of space/quote/comma/colon/dot/hyphen -> '-'."""
    return F.lower(F.regexp_replace(_c(c), TITLE_SEPARATORS, "-"))


def category(c) -> Column:
    """Commercial-category cleaning: ' / ' -> '/', then runs of space/comma/hyphen -> '-'."""
    return F.lower(F.regexp_replace(F.replace(_c(c), F.lit(" / "), F.lit("/")), CATEGORY_SEPARATORS, "-"))


def genre_commas(c) -> Column:
    """'a, b' -> 'a,b' (the genre map separates with comma + space)."""
    return F.replace(_c(c), F.lit(", "), F.lit(","))


def genre(c) -> Column:
    """Genre list as stored in the content detail: comma-joined, lower, hyphenated."""
    return lower_hyphen(genre_commas(c))


def source_class(input_category) -> Column:
    """'Linear' iff the input category is HD TV or SD TV, else 'Streaming'.

    Content tables store the category upper-cased and hyphenated ('HD-TV'),
    ad tables raw ('HD TV'); both are compared after undoing the hyphen.
    NULL category -> NULL class.
    """
    norm = F.replace(F.upper(_c(input_category)), F.lit("-"), F.lit(" "))
    return (F.when(norm.isin("HD TV", "SD TV"), F.lit("Linear"))
            .when(norm.isNotNull(), F.lit("Streaming")))


def csv_contains(c, token: str, exact: bool = False) -> Column:
    """Substring test on a CSV list (documented spelling) or exact token test."""
    if exact:
        return F.array_contains(F.split(_c(c), ","), F.lit(token))
    return _c(c).contains(token)
