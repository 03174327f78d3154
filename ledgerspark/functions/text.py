"""Text expressions."""

from pyspark.sql import Column, functions as F

# Fixed value: the characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Texts that a delimited file uses for "no value".
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _odd(code: Column) -> Column:
    """A character code that is no printable ASCII character; 0 stands for an empty text."""
    return (code <= 32) | (code >= 127)


def strip(text: Column) -> Column:
    """Remove white space of every kind, tabs included, from both ends.

    Plain blanks are trimmed first; the long character list is only consulted
    if an end then still shows something other than printable ASCII.
    """
    inner = F.trim(text)
    odd_end = _odd(F.ascii(inner)) | _odd(F.ascii(F.substring(inner, -1, 1)))
    return F.when(odd_end, F.btrim(inner, F.lit(WHITE_SPACE))).otherwise(inner)


def is_blank(text: Column) -> Column:
    inner = F.trim(text)
    only_odd = _odd(F.ascii(inner)) & (F.btrim(inner, F.lit(WHITE_SPACE)) == "")
    return text.isNull() | only_odd


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest.

    initcap only looks at blanks, so it serves texts of plain words; the
    character-wise form runs on the remaining ones only.
    """
    letters = F.split(F.lower(text), "")
    by_character = F.array_join(
        F.transform(
            letters,
            lambda letter, i: F.when(
                (i == 0) | ~F.get(letters, i - 1).rlike(r"\p{L}"), F.upper(letter)
            ).otherwise(letter),
        ),
        "",
    )
    return F.when(text.rlike("^[A-Za-z ]*$"), F.initcap(text)).otherwise(by_character)


def null_if_missing_token(text: Column) -> Column:
    return F.when(~text.isin(MISSING_TOKENS), text)
