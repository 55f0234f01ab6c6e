import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexweave.functions import text as T


def test_remove_marks():
    assert T.remove_marks("café naïve Ångström") == "cafe naive Angstrom"
    assert T.remove_marks("plain") == "plain" and T.remove_marks(None) is None
    assert T.remove_marks("한") == unicodedata.normalize("NFD", "한")
    assert T.remove_marks("が") == "が"


def test_norm_in_the_jvm_equals_python(spark):
    words = ["CAFÉ", "naïve", "Ångström", "한국어", "がぎ", "ǅ", "ﬁn", "é", "ạ́", "Ḉ", "q̣̇", "ß", "Łódź", "日本", "\U0001d400x", None, ""]
    rows = T.with_norm(spark.createDataFrame([(w,) for w in words], "form string")).collect()
    assert len(rows) == len(words)
    for r in rows:
        assert r["norm"] == (None if r["form"] is None else T.remove_marks(r["form"].lower())), r["form"]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab*?[]^-c.x(\\", max_size=8), st.text(alphabet="abc.x(\\-^", max_size=6))
def test_glob_regex_equals_sqlite(pattern, value):
    import re
    import sqlite3

    if "[" in pattern and ("[]" in pattern or "[^]" in pattern or pattern.count("[") != pattern.count("]") or "-" in pattern):
        return
    want = sqlite3.connect(":memory:").execute("SELECT ? GLOB ?", (value, pattern)).fetchone()[0]
    if "[" in pattern and not re.fullmatch(r"(?:[^\[\]]|\[\^?[^\[\]^]+\])*", pattern):
        return
    got = re.compile(T.glob_to_regex(pattern).replace("\\z", "\\Z")).search(value) is not None
    assert got == bool(want)


def test_glob_in_spark(spark):
    df = spark.createDataFrame([("dog",), ("dogfish",), ("hotdog",), ("Dog",), ("d.g",)], "form string")
    find = lambda p: {r[0] for r in df.filter(T.glob(F.col("form"), p)).collect()}
    assert find("dog*") == {"dog", "dogfish"} and find("*dog") == {"dog", "hotdog"} and find("d?g") == {"dog", "d.g"} and find("d.g") == {"d.g"} and find("[c-e]og") == {"dog"}


def test_search_mode():
    assert T.search_mode("def: animal ") == ("def", "animal") and T.search_mode("i12") == ("ili", "i12") and T.search_mode("cili.i3") == ("ili", "i3")
    assert T.search_mode("dog*") == ("glob", "dog*") and T.search_mode(" dog ") == ("exact", "dog") and T.search_mode("in") == ("exact", "in")


def test_small_functions(spark):
    one = lambda expr, value: spark.createDataFrame([(value,)], "c string").select(expr(F.col("c"))).first()[0]
    assert one(T.ascii_lower, "ÉA") == "Éa"
    assert one(T.pos_of, "s") == "ADJ" and one(T.pos_of, "?") == "UNK"
    assert one(T.pos_of_origin, "pwn-3.0:00001740-N") == "NOUN"
    with pytest.raises(Exception, match="no part of speech"):
        one(T.pos_of_origin, "")
    assert tuple(one(T.origin_parts, "pwn-3.0:00001740-n")) == ("pwn", "3.0", "00001740-n")
    with pytest.raises(Exception, match="unexpected origin"):
        one(T.origin_parts, "pwn-3.1:1")
    assert one(T.collapse_space, " a \t\n b c ") == "a b c" and one(T.collapse_space, None) is None
    assert one(T.normalize_text, "A  b!? ") == "a b"
    assert T.xml_id("a b-é") == "ax0020bx002Dx00E9"
    assert one(T.sense_key, "oewn-run__2.38.00..") == "run%2:38:00::"
    assert one(T.package_stem, "https://x/y/omw-fr-1.4.tar.xz") == "omw-fr" and one(T.package_version, "https://x/y/omw-fr-1.4.tar.xz") == "1.4"
    assert one(T.package_version, "https://x/v2.1/own.xml") == "2.1" and one(T.resource_code, "oewn-2024_1.0") == "oewn"
    for url, label in (
        ("https://creativecommons.org/licenses/by/4.0/", "CC BY 4.0"), ("https://creativecommons.org/licenses/by-sa/3.0/", "CC BY-SA 3.0"), ("https://creativecommons.org/licenses/by/2.0/", "CC BY"),
        ("https://opensource.org/licenses/Apache-2.0", "Apache 2.0"), ("http://www.cecill.info/x", "CeCILL-C"), ("WordNet", "WordNet"), ("", "N/A"), (None, "N/A"), ("permitted use", "permitted use"),
    ):
        assert one(T.licence_label, url) == label
    assert one(T.thousands, "1234567") == "1,234,567" and one(T.thousands, None) == "---"
    assert one(T.citation_html, "Doe. `Site <http://x>`_. In *Proc*.") == 'Doe. <a href="http://x">Site</a>. In <em>Proc</em>.'
    assert one(lambda c: T.contains_ascii(c, "A%_"), "xa%_y") and not one(lambda c: T.contains_ascii(c, "a%"), "abc")
