"""Text expressions: punctuation, words, characters, tokens."""

from __future__ import annotations

import string
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCTUATION = string.punctuation

# The characters a Python str.split() treats as white space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# No group is repeated without bound, as that would take a stack as deep as a token is long; and what stands before a
# mark that may not come has at most the 253 characters of a host, so that no run is searched again from each place.
#
# The forms that a common tokenizer of short messages keeps whole, in the order it tries them. The
# pattern for phone numbers and those for emoticons, names, tags and words follow NLTK (Apache License 2.0).
_WORD = r"[a-zA-Z\p{L}\p{M}\p{N}_]"
_LETTER = r"[a-zA-Z\p{L}\p{M}]"
_IN_URL = r"[^\s()<>{}\[\]]*"
TOKEN_FORMS = (
    # not a form of its own: a plain word before a blank, which no other form begins with
    r"[a-zA-Z]{2,}+(?!\S)",
    # an address: a scheme or a domain with a path, brackets in pairs, no mark at the end
    rf"(?:[hH][tT][tT][pP][sS]?:(?:/{{1,3}}|[a-zA-Z0-9%])|(?=[a-zA-Z0-9.\-]{{1,253}}+/)[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,13}}/)"
    rf"{_IN_URL}(?:\([^\s()]*\){_IN_URL}){{0,100}}"
    r"""(?<=[^\s`!;:'".,?«»“”‘’({\[<>\]}])""",
    r"\+?[01][ *\-.)]*(?:\(?[0-9]{3}[ *\-.)]*)?[0-9]{3}[ *\-.)]*[0-9]{4}",
    r"(?:\(?[0-9]{3}[ *\-.)]*)?[0-9]{3}[ *\-.)]*[0-9]{4}",
    r"[<>]?[:;=8][\-o*']?[)\](\[dDpP/:}{@|\\]",
    r"[)\](\[dDpP/:}{@|\\][\-o*']?[:;=8][<>]?",
    r"<3",
    r"<[^>\s]+>",
    r"<?-+>|<-+>?",
    rf"@{_WORD}+",
    rf"#+{_WORD}[a-zA-Z\p{{L}}\p{{M}}\p{{N}}_'\-]*{_WORD}",
    r"[a-zA-Z\p{L}\p{M}\p{N}_.+\-]{1,253}+@[\p{L}\p{M}\p{N}_\-]+\.[\p{L}\p{M}\p{N}_.\-]*[\p{L}\p{M}\p{N}_]",
    # a domain without a scheme, of 127 labels at most; behind the e-mail addresses, which may begin like one
    rf"(?=[a-zA-Z0-9\-]{{1,253}}+\.[a-zA-Z0-9])[a-zA-Z0-9]+(?:[.\-][a-zA-Z0-9]+){{0,125}}\.[a-zA-Z]{{2,13}}(?!{_WORD})/?",
    rf"{_LETTER}[a-zA-Z\p{{L}}\p{{M}}'\-_]*{_LETTER}",
    r"[+\-]?[0-9]+[,/.:\-][0-9]+[+\-]?",
    rf"{_WORD}+",
    r"\.[\s.]*\.",
    r"\S",
)
TOKEN_PATTERN = f"({'|'.join(TOKEN_FORMS)})"

# Listed one by one, which the JVM tests with one look at a table, and some ten times as fast as ranges.
_PLAIN = string.ascii_letters + string.digits + r" \t\n\r\f\x0B"

# A character reference of HTML; Windows-1252 stands behind the numbers 128 to 159.
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
NAMED = {name: chr(code) for name, code in name2codepoint.items()}


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def _spaced(text: Column, drop: str = "") -> Column:
    """Every white-space character becomes one blank; characters in ``drop`` vanish.

    One pass over the text, and it lets the split below use a single literal
    character, which the JVM does without a regular expression.
    """
    return F.translate(text, SPACES + drop, " " * len(SPACES))


def split_words(text: Column) -> Column:
    """Words between runs of white space, as ARRAY<STRING>."""
    return F.array_remove(F.split(_spaced(text), " "), "")


def clean_words(text: Column) -> Column:
    """Lower-case words without punctuation. Empty strings are left in for the
    caller to filter after ``explode``, where the test is code-generated."""
    return F.split(F.lower(_spaced(text, PUNCTUATION)), " ")


def characters(text: Column) -> Column:
    """Code points of a string as ARRAY<STRING>."""
    return F.split(text, "")


def _character(reference: Column) -> Column:
    """What one character reference stands for; an unknown name or number for nothing."""
    body = F.substring(reference, 2, 1 << 30)
    body = F.substring_index(body, ";", 1)
    number = F.when(
        body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 8), 16, 10).cast("int")
    ).otherwise(F.substring(body, 2, 8).cast("int"))
    windows = F.get(F.lit([bytes([b]).decode("cp1252", "ignore") for b in range(128, 160)]), number - 128)
    unicode = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    known = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    by_number = F.when(number.between(128, 159), windows).otherwise(F.when(known, unicode))
    names = F.create_map(*(F.lit(x) for pair in NAMED.items() for x in pair))
    by_name = F.try_element_at(names, body)
    return F.coalesce(F.when(body.startswith("#"), by_number).otherwise(by_name), F.lit(""))


def decode_references(text: Column) -> Column:
    """Character references (``&amp;``, ``&#233;``, ``&#xe9;``) as the characters they stand for, in
    one pass: what comes out is not looked at again. Unknown ones vanish."""
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    between = F.split(text, _REFERENCE, -1)
    whole = F.concat(F.transform(found, _character), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(between, whole, lambda a, b: F.concat(a, b)), "")
    return F.when(text.contains("&") & text.contains(";"), joined).otherwise(text)


def tokens(text: Column) -> Column:
    """Tokens as ARRAY<STRING>.

    Character references are decoded first, and of four or more equal marks in
    a row three are left, as a tokenizer of messages does. No token starts with
    a blank, so the lookahead changes no result; it saves trying every kind of
    token at every blank.
    """
    short = F.regexp_replace(decode_references(text), rf"([^{_PLAIN}])\1\1\1+", "$1$1$1")
    return F.regexp_extract_all(short, F.lit(r"(?=\S)" + TOKEN_PATTERN), F.lit(1))


def text_length(text: Column) -> Column:
    """Length in code points, BIGINT."""
    return F.length(text).cast("bigint")
