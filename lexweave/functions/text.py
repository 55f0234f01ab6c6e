"""Scalar functions on text. Everything runs in the JVM except what names an Arrow function."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..model import POS_OF_CODE, RESOURCE_ATTRIBUTES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Combining marks that a search ignores.
MARKS = ((0x0300, 0x036F), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))


_MARK_RUN = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in MARKS) + "]+")


def remove_marks(text: str | None) -> str | None:
    """Canonical decomposition without the MARKS; stays decomposed."""
    return text if text is None or text.isascii() else _MARK_RUN.sub("", unicodedata.normalize("NFD", text))


def is_ascii(c: Column) -> Column:
    """As many bytes as characters: no pattern has to be run."""
    return F.octet_length(c) == F.length(c)


@F.pandas_udf(StringType())
def remove_marks_arrow(s):  # noqa: ANN001, ANN201
    return s.map(remove_marks, na_action="ignore")


def with_norm(df: DataFrame, column: str = "form", name: str = "norm") -> DataFrame:
    """df with the search form: lower case, then without marks.

    Only text beyond ASCII is sent to Python, in Arrow batches; other rows send a null. (translate() over a table of the
    decomposable characters stays in the JVM, but was ten times slower on whole texts and cannot express Hangul.)
    """
    low = F.lower(F.col(column))
    return df.withColumn(name, F.coalesce(remove_marks_arrow(F.when(~is_ascii(low), low)), low))


def normalize_term(term: str) -> str:
    return remove_marks(term.lower())


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def like_ascii(c: Column, pattern: str) -> Column:
    """LIKE that ignores the case of A-Z only."""
    return ascii_lower(c).like(pattern.translate(str.maketrans(UPPER, LOWER)))


def contains_ascii(c: Column, part: str) -> Column:
    """Whether c contains part, which is a value and never a pattern, ignoring the case of A-Z."""
    return ascii_lower(c).contains(part.translate(str.maketrans(UPPER, LOWER)))


def glob_to_regex(glob: str) -> str:
    """An anchored regular expression for * ? [a-z] [^c]; every other character stands for itself."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append("[\\s\\S]*")
        elif c == "?":
            out.append("[\\s\\S]")
        elif close > 0:
            body = glob[i + 1 : close]
            negated = body.startswith("^")
            inner = "".join("-" if x == "-" else re.escape(x) for x in body[negated:])
            out.append(f"[{'^' if negated else ''}{inner}]")
            i = close
        else:
            out.append(re.escape(c))
        i += 1
    return "\\A" + "".join(out) + "\\z"


def glob(c: Column, pattern: str) -> Column:
    """Whole-string, case-sensitive. A prefix pattern becomes startswith, which reaches the Parquet scan."""
    head = pattern[:-1]
    if not any(x in pattern for x in "*?["):
        return c == pattern
    if pattern.endswith("*") and not any(x in head for x in "*?["):
        return c.startswith(head)
    return c.rlike(glob_to_regex(pattern))


def search_mode(term: str) -> tuple[str, str]:
    """(mode, value): def:x, an interlingual id (i1 or cili.i1), a glob, or an exact form."""
    term = term.strip()
    if term.startswith("def:"):
        return "def", term[4:].strip()
    if m := re.fullmatch(r"(?:cili\.)?(i\d+)", term):
        return "ili", m[1]
    return ("glob" if "*" in term else "exact"), term


def pos_of(c: Column) -> Column:
    pairs = [F.lit(x) for kv in POS_OF_CODE.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(F.trim(c))), F.lit("UNK"))


def pos_of_origin(origin: Column) -> Column:
    """Part of speech from the last letter of an origin; an empty or unknown one is an error."""
    code = F.lower(F.right(F.trim(origin), F.lit(1)))
    pairs = [F.lit(x) for kv in POS_OF_CODE.items() for x in kv]
    pos = F.element_at(F.create_map(*pairs), code)
    return F.when(pos.isNotNull(), pos).otherwise(F.raise_error(F.concat(F.lit("no part of speech in origin: "), F.coalesce(origin, F.lit("null")))).cast("string"))


def origin_parts(origin: Column) -> Column:
    """name, version and id of `pwn-3.0:id`; any other origin is an error."""
    pattern = r"^(pwn)-(3\.0):(.+)$"
    ok = F.coalesce(origin.rlike(pattern), F.lit(False))
    part = lambda k: F.when(ok, F.regexp_extract(origin, pattern, k)).otherwise(F.raise_error(F.concat(F.lit("unexpected origin: "), F.coalesce(origin, F.lit("null")))).cast("string"))
    return F.struct(part(1).alias("name"), part(2).alias("version"), part(3).alias("id"))


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | $", "")


def normalize_text(c: Column) -> Column:
    """Collapsed white space, no closing punctuation, lower case."""
    return F.lower(F.regexp_replace(collapse_space(c), r"[.,;:!?]+$", ""))


def xml_id(text: str | None) -> str | None:
    """A-Z, a-z and 0-9 stay; any other character becomes x and its code point in hexadecimal, four digits at least."""
    return text if text is None else "".join(c if c.isascii() and c.isalnum() else f"x{ord(c):04X}" for c in text)


@F.pandas_udf(StringType())
def xml_id_arrow(s):  # noqa: ANN001, ANN201
    return s.map(xml_id, na_action="ignore")


def sense_key(c: Column) -> Column:
    """oewn-x__3.00.00.. as x%3:00:00::"""
    body = F.regexp_replace(c, "^oewn-", "")
    head, tail = F.split_part(body, F.lit("__"), F.lit(1)), F.split_part(body, F.lit("__"), F.lit(2))
    return F.when(body.contains("__"), F.concat(head, F.lit("%"), F.replace(tail, F.lit("."), F.lit(":")))).otherwise(body)


def offset_id(offset: Column, pos: Column) -> Column:
    return F.concat(F.lpad(offset.cast("string"), 8, "0"), F.lit("-"), pos)


def package_stem(url: Column) -> Column:
    """Last path part without archive and .xml suffixes, and without a trailing -digits version."""
    name = F.element_at(F.split(url, "/"), -1)
    bare = F.regexp_replace(F.regexp_replace(name, r"\.(tar\.gz|tar\.xz|tgz|gz|xz|zip)$", ""), r"\.xml$", "")
    return F.regexp_replace(bare, r"-[\d.]+$", "")


def package_version(url: Column) -> Column:
    """Version at the end of the name, else from a /vX.Y/ part of the path, else null."""
    name = F.regexp_replace(F.element_at(F.split(url, "/"), -1), r"(\.(tar\.gz|tar\.xz|tgz|gz|xz|zip|xml))+$", "")
    of_name, of_path = F.regexp_extract(name, r"-(\d[\d.]*)$", 1), F.regexp_extract(url, r"/v(\d[\d.]*)/", 1)
    return F.coalesce(F.nullif(of_name, F.lit("")), F.nullif(of_path, F.lit("")))


def resource_code(stem: Column) -> Column:
    return F.regexp_replace(stem, r"([-_]\d[\d.\-]*)+$", "")


# Parts of licence addresses, in order, and their labels.
LICENCES = (
    ("creativecommons.org/licenses/by/4", "CC BY 4.0"),
    ("creativecommons.org/licenses/by/3", "CC BY 3.0"),
    ("creativecommons.org/licenses/by-sa/4", "CC BY-SA 4.0"),
    ("creativecommons.org/licenses/by-sa/3", "CC BY-SA 3.0"),
    ("creativecommons.org/licenses/by-sa/", "CC BY-SA"),
    ("creativecommons.org/licenses/by-nc/4", "CC BY-NC 4.0"),
    ("creativecommons.org/licenses/by/", "CC BY"),
    ("opensource.org/licenses/Apache-2.0", "Apache 2.0"),
    ("opensource.org/licenses/MIT", "MIT"),
    ("cecill.info", "CeCILL-C"),
    ("opendefinition.org/licenses/odc-by", "ODC-BY"),
)


def licence_label(url: Column) -> Column:
    """A short label for a licence's address or name: the first part of LICENCES that it contains, else as it is."""
    out = F.when(F.coalesce(url, F.lit("")) == "", "N/A").when(F.lower(url) == "wordnet", "WordNet")
    for part, label in LICENCES:
        out = out.when(url.contains(part), label)
    return out.otherwise(url)


def thousands(n: Column) -> Column:
    return F.coalesce(F.format_number(n.cast("long"), 0), F.lit("---"))


def extra_json(attributes: Column) -> Column:
    """Attributes of a resource outside the known ones, as JSON; null if there are none."""
    rest = F.map_filter(attributes, lambda k, _: ~k.isin(*RESOURCE_ATTRIBUTES))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def number_or_null(c: Column) -> Column:
    return c.try_cast("double")


def preview(c: Column, n: int = 60) -> Column:
    return F.substring(c, 1, n)


def citation_html(c: Column) -> Column:
    """`text <address>`_ as a link and *text* as emphasis."""
    linked = F.regexp_replace(c, r"`([^`<]+?)\s*<([^>]+)>`__?", r'<a href="$2">$1</a>')
    return F.regexp_replace(linked, r"\*([^*]+)\*", r"<em>$1</em>")
