"""Text expressions: trimming, escaping, loose booleans, URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bagyard import constants as K

# Characters the JVM's String.trim strips: every code point <= U+0020.
_JTRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c) -> Column:
    """Trim like the JVM (all control characters and blanks), not only spaces."""
    return F.regexp_replace(_c(c), _JTRIM, "")


def blank_to_null(c) -> Column:
    """``nullif(trim(c), '')`` with JVM trim semantics."""
    t = jtrim(c)
    return F.when(t != "", t)


def is_blank(c) -> Column:
    return F.coalesce(jtrim(c) == "", F.lit(True))


def xml_escape(c) -> Column:
    """Escape text for XML element content or a double-quoted attribute."""
    x = F.replace(_c(c), F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    x = F.replace(x, F.lit(">"), F.lit("&gt;"))
    return F.replace(x, F.lit('"'), F.lit("&quot;"))


def loose_boolean(c) -> Column:
    """case-insensitive true/yes/on, no trimming; anything else is false."""
    return F.coalesce(F.lower(_c(c)).isin(*K.TRUE_WORDS), F.lit(False))


def clean_message(c) -> Column:
    """'<' and '>' escaped once; a blank message becomes empty."""
    escaped = F.replace(F.replace(_c(c), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.when(_c(c).isNull() | is_blank(_c(c)), F.lit("")).otherwise(escaped)


def remark(privacy, message) -> Column:
    """privacy remark, blank line, message; trimmed like the JVM."""
    return jtrim(F.concat(F.coalesce(_c(privacy), F.lit("")), F.lit("\n\n"), F.coalesce(_c(message), F.lit("")), F.lit("\n")))


def https_to_http(uri) -> Column:
    """exact lower-case ``https`` scheme becomes ``http``."""
    return F.regexp_replace(_c(uri), r"^https:", "http:")


def last_segment(c, sep: str = ":") -> Column:
    """text after the last separator."""
    return F.element_at(F.split(_c(c), sep, -1), -1)


def fedora_object(pid) -> Column:
    """relation object naming a repository object."""
    return F.concat(F.lit(K.FEDORA_PREFIX), _c(pid))


def relation_object(kind, value) -> Column:
    """tagged relation object ``struct(object_kind, object)``."""
    return F.struct(_c(kind).alias("object_kind"), _c(value).alias("object"))


def has_http_protocol(url) -> Column:
    """The protocol of a URL must start with ``http``, in any case; not a URL = false."""
    proto = F.lower(F.try_parse_url(_c(url), F.lit("PROTOCOL")))
    return F.coalesce(proto.startswith("http"), F.lit(False))


def is_ascii(c) -> Column:
    return ~_c(c).rlike(r"[^\x00-\x7F]")
