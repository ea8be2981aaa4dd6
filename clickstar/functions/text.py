"""Cleaning of text, ids and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character Unicode counts as white space (plus the ASCII separators that
# ``str.strip`` removes); Spark's own trim only drops the blank.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

HTTP_URL = r"(?i)^https?://[^/?#]+"


def trim_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def trim_quick(c: Column) -> Column:
    """:func:`trim_ws` for columns of many rows; it names the column several times.

    Blanks go first, a byte at a time.  If visible ASCII characters are at both ends then, nothing else is
    left to go; only other text is compared with every kind of white space, which is twenty times as dear.
    """
    text = F.btrim(c)
    # Compared as wholes, texts are in the order of their first bytes; the last byte needs no count of characters.
    last = F.substring(text.cast("binary"), -1, 1)
    visible = text.between("!", "\x7f") & last.between(F.lit(bytearray(b"!")), F.lit(bytearray(b"~")))
    return F.when(visible, text).otherwise(trim_ws(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_quick(c), F.lit(""))


def clean_id(c: Column, data_type: T.DataType = T.StringType()) -> Column:
    """Id as trimmed text; NULL for blanks and for booleans."""
    if isinstance(data_type, T.BooleanType):
        return F.lit(None).cast("string")
    return blank_to_null(c.cast("string"))


def normal_id(c: Column) -> Column:
    """Id text for comparisons: a number that went through a float loses its ``.0``."""
    return F.regexp_replace(trim_ws(c.cast("string")), r"^(\d+)\.0$", "$1")


def same_id(a: Column, b: Column) -> Column:
    return normal_id(a) == normal_id(b)


def clean_url(c: Column) -> Column:
    """The trimmed URL if it is http(s), in any case, with a host; else NULL."""
    url = trim_ws(c)
    return F.when(url.rlike(HTTP_URL), url)


def store_domain(url: Column) -> Column:
    """Last label of the host with its dot (``.uk``), NULL without host or dot.

    The scheme is matched in lower case only, so ``HTTPS://`` yields NULL.
    """
    scheme = F.when(F.startswith(url, F.lit("https://")), 9).when(F.startswith(url, F.lit("http://")), 8)
    rest = F.substr(url, scheme)
    host = F.substring_index(F.substring_index(rest, "/", 1), ":", 1)
    # Without a dot the label is the host itself.
    label = F.substring_index(host, ".", -1)
    return F.when((label != "") & (label != host), F.concat(F.lit("."), F.lower(label)))


def url_quote(c: Column) -> Column:
    """Percent-encode everything but letters, digits and ``_.-~``."""
    encoded = F.url_encode(c)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def last_chars(c: Column, n: int | None = None) -> Column:
    """The last ``n`` characters; the whole text without ``n``."""
    return c if n is None else F.right(c, F.lit(n))


def mask_email(c: Column) -> Column:
    """Governed view of an address: a digest that still joins, and no readable part."""
    return F.when(c.isNotNull(), F.sha2(F.lower(trim_ws(c)), 256))


def split_uri(c: Column) -> Column:
    """``scheme://bucket/prefix`` as a struct; NULL where it is not such a URI."""
    pattern = r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://([^/]+)(?:/(.*))?$"
    return F.when(
        c.rlike(pattern),
        F.struct(
            F.regexp_extract(c, pattern, 1).alias("scheme"),
            F.regexp_extract(c, pattern, 2).alias("bucket"),
            F.btrim(F.regexp_extract(c, pattern, 3), F.lit("/")).alias("prefix"),
        ),
    )


def relative_name(name: Column, prefix: Column) -> Column:
    """Object name below a prefix; NULL if the object lies outside of it."""
    return (
        F.when(prefix == "", name)
        .when(F.startswith(name, F.concat(prefix, F.lit("/"))),
              F.substring(name, F.length(prefix) + 2, F.length(name)))
    )
