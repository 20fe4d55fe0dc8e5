"""Text clean-up, all as built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column | str) -> Column:
    """Both ends freed of every whitespace character; ``F.trim`` only knows the blank."""
    return F.btrim(c, F.lit(WHITESPACE))


def key_text(c: Column | str) -> Column:
    """Padded code as a join key: the databases ignore trailing blanks, Spark does not."""
    return F.rtrim(c)


def is_live(flag: Column | str) -> Column:
    """Soft-delete flag is blank, whatever its padding."""
    return F.rtrim(flag) == ""


def is_pattern(text: Column) -> Column:
    """Whether a text can be searched as a pattern; NULL cannot. For projections only."""
    compiled = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), text)
    return text.isNotNull() & compiled.isNotNull()


def contains(text: Column, part: Column | str, regex: bool = False) -> Column:
    """Case-sensitive search; a NULL text never matches. A pattern must be well-formed."""
    part = part if isinstance(part, Column) else F.lit(part)
    hit = F.regexp_like(text, part) if regex else F.contains(text, part)
    return F.coalesce(hit, F.lit(False))


def without_semicolons(df: DataFrame) -> DataFrame:
    """Every string column with ``;`` replaced by a blank."""
    return df.select(
        *[
            F.translate(f.name, ";", " ").alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
