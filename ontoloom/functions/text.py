"""Column functions on text: white space, identifiers, sanitisers of ontology files.

White space means what Python's ``strip`` removes: Spark's own ``trim`` takes
spaces only and Java's ``\\s`` is ASCII, so the class is spelled with ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def utf8(content: Column) -> Column:
    """Bytes as text, those that aren't UTF-8 replaced; a byte order mark at the start is none of the text."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^\ufeff", "")


def ws_strip(x: Column) -> Column:
    return F.regexp_replace(x, _EDGE, "")


def words(x: Column) -> Column:
    """The tokens of a string, none for a blank one."""
    return F.filter(F.split(ws_strip(x), _SPACE), lambda t: t != "")


def or_default(x: Column, default) -> Column:
    """``x``, or the default where it is null or empty."""
    return F.coalesce(F.nullif(x, F.lit("")), default if isinstance(default, Column) else F.lit(default))


def one_line(x: Column) -> Column:
    return F.translate(x, "\n\t", "  ")


def short_version(x: Column) -> Column:
    """The first three words, on one line; NA if there is none."""
    return or_default(F.array_join(F.slice(words(one_line(F.coalesce(x, F.lit("")))), 1, 3), " "), "NA")


def acronym(x: Column) -> Column:
    return F.upper(ws_strip(x))


def header_filename(header: Column) -> Column:
    """The file name of a Content-Disposition header; null without one."""
    return F.replace(F.get(F.split(header, "filename="), F.lit(1)), F.lit('"'), F.lit(""))


def snippet(body: Column, length: int = 200) -> Column:
    return F.trim(F.regexp_replace(F.substring(F.coalesce(body, F.lit("")), 1, length), _SPACE, " "))


def path_part(path: Column, k: int) -> Column:
    """The k-th part (from 1) of a relative path, null if there is none."""
    return F.get(F.split(path, "/"), F.lit(k - 1))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """With its dot, lower-cased; a name that starts with its only dot has none."""
    return F.lower(F.regexp_extract(basename(path), r"^\.*[^.].*?(\.[^.]*)$", 1))


def stem(path: Column) -> Column:
    """The base name without its extension."""
    name = basename(path)
    return F.when(extension(path) == "", name).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))


def archive_stem(path: Column) -> Column:
    """Lower-cased base name without .gz or .zip, then .tar, then one more extension."""
    name = F.regexp_replace(basename(path), r"(?i)\.(gz|zip)$", "")
    return F.lower(stem(F.regexp_replace(name, r"(?i)\.tar$", "")))


def short_category(x: Column) -> Column:
    """What follows the first colon."""
    return F.when(F.instr(x, ":") > 0, x.substr(F.instr(x, ":") + 1, F.length(x))).otherwise(x)


def html_escape(x: Column) -> Column:
    out = F.coalesce(x, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def blurb(x: Column, length: int = 110) -> Column:
    t = ws_strip(F.coalesce(x, F.lit("")))
    return F.when(F.length(t) > length, F.concat(F.substring(t, 1, length), F.lit("…"))).otherwise(t)


def url_host(x: Column) -> Column:
    return F.split(F.element_at(F.split(x, "//"), -1), "/").getItem(0)


def last_segment(x: Column) -> Column:
    """The last part of a URL's path, which also labels a repository."""
    return F.element_at(F.split(F.regexp_replace(x, "/+$", ""), "/"), -1)


def deep_link(base: str, x: Column) -> Column:
    """The page of one id under a service's base URL."""
    return F.concat(F.lit(base.rstrip("/") + "/"), x)


def search_blob(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *parts))


# --- ontology text ---------------------------------------------------------------

# Fixed patterns: import declarations in RDF/XML (empty and paired) and in OWL/XML.
IMPORTS = (
    r"[ \t]*<owl:imports\b[^>]*/>[ \t]*\n?",
    r"(?s)[ \t]*<owl:imports\b[^>]*>.*?</owl:imports>[ \t]*\n?",
    r"(?s)[ \t]*<(?:owl:)?Import\b[^>]*>.*?</(?:owl:)?Import>[ \t]*\n?",
)
# Fixed pattern: an xml:lang attribute whose value is neither empty nor a language tag.
BAD_LANG = r"""(?U)\s+xml:lang\s*=\s*(["'])(?!\1)(?![a-zA-Z]+(?:-[a-zA-Z0-9]+)*\n?\1)((?:(?!\1).)*)\1"""


def looks_like_xml(text: Column) -> Column:
    """An XML serialisation, by its first 400 letters."""
    head = F.lower(F.regexp_replace(F.substring(text, 1, 400), r"(?U)^[\s\x1c-\x1f]+", ""))
    return F.startswith(head, F.lit("<?xml")) | F.contains(head, F.lit("<rdf:rdf")) | F.contains(head, F.lit("<ontology"))


def strip_imports(text: Column) -> Column:
    """Without import declarations, where the text is XML; the cheap test comes first."""
    out = text
    for p in IMPORTS:
        out = F.regexp_replace(out, p, "")
    return F.when(looks_like_xml(text) & F.lower(text).contains("import"), out).otherwise(text)


def count_imports(text: Column) -> Column:
    """How many declarations ``strip_imports`` removes, each pattern on what the ones before have left."""
    left, n = text, F.lit(0)
    for p in IMPORTS:
        n = n + F.regexp_count(left, F.lit(p))
        left = F.regexp_replace(left, p, "")
    return F.when(looks_like_xml(text), n).otherwise(F.lit(0)).cast("long")


def strip_bad_lang(text: Column) -> Column:
    """Without xml:lang attributes that hold no language tag; the literals stay."""
    return F.when(text.contains("xml:lang"), F.regexp_replace(text, "(?s)" + BAD_LANG, "")).otherwise(text)


def bad_langs(text: Column) -> Column:
    """The values that ``strip_bad_lang`` drops, in their order."""
    return F.when(text.contains("xml:lang"), F.regexp_extract_all(text, F.lit("(?s)" + BAD_LANG), F.lit(2))).otherwise(F.array().cast("array<string>"))


def valid_lang(tag: Column) -> Column:
    return (tag == "") | tag.rlike(r"^[a-zA-Z]+(-[a-zA-Z0-9]+)*$")
