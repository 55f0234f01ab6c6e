"""Each row operator under the same conditions: nulls, empty and long texts, repeated rows, empty tables, columns of our names."""

import pytest

from lexweave.llm import fmindex, gif, html, langid, linedup, mixing, paragraphs, quality, simhash

LONG = "some words of a long text that goes on and on " * 4000
TEXT = "The first of the words here are followed by ten others, which makes a window."
ROWS = [(1, TEXT, "s"), (1, TEXT, "s"), (None, TEXT + " And more.", None), (None, None, "s"), (2, "", "t"), (3, " \n\t", "t"), (4, LONG, "s"), (5, TEXT, "s")]
OURS = (
    "_d _h _gone _run n_lines n_removed longest_run spans repeats_of classes short _v_spans _extra fingerprint payload_bytes payload_sha256 tail_crc32 media_bytes "
    "media_sha256 feature media payload frames mix_source mix_rate mix_seed source_size target copies copy_no n_words hit_words hit_items _before_hits "
    "_before_items clean_text words_left lang_pred score langs predicted n_chars left"
).split()


def _benchmark(spark):
    return spark.createDataFrame([("a", TEXT), ("b", TEXT), (None, "x y"), ("c", None)], "item_id string, text string")


def _language(spark, docs):
    known = spark.createDataFrame([(k, "en" if k % 2 else "de", "the of and" if k % 2 else "der die das") for k in range(40)], "doc_id long, lang string, text string")
    return langid.identify(spark, docs, langid.fit(known))


def _quality(spark, docs):
    known = spark.createDataFrame([(k, f"Good words {k}, all of them." if k % 2 else f"BAD !!! ### {k}") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    return quality.score(spark, docs, quality.fit(known, labels))


#: Operator, and whether it keeps every row.
OPERATORS = {
    "language": (_language, True),
    "lines": (linedup.dedup_lines, True),
    "simhash": (simhash.keep_one, False),
    "paragraphs": (paragraphs.remove_repeats, True),
    "media": (lambda spark, docs: gif.digests(x := gif.encode_column(docs), x.columns[-1]), True),
    "mixing": (mixing.mix, False),
    "decontaminated": (lambda spark, docs: fmindex.decontaminate(spark, docs, _benchmark(spark)), False),
    "html": (lambda spark, docs: html.extract(docs, "text"), True),
    "quality": (_quality, True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_conditions(spark, name):
    run, keeps = OPERATORS[name]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in OURS)
    docs = spark.createDataFrame([(*r, *range(len(OURS))) for r in ROWS], schema).repartition(2)
    out = run(spark, docs)
    assert out.columns[: len(docs.columns)] == docs.columns and len({c.lower() for c in out.columns}) == len(out.columns)
    got = out.collect()
    assert all([r[c] for c in OURS] == list(range(len(OURS))) for r in got)
    assert not keeps or sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
    # Repeated rows get equal results.
    once = [r for r in got if r["doc_id"] == 1]
    assert len(set(map(str, once))) <= 1 or name == "mixing"
    assert run(spark, docs.limit(0)).collect() == []


def test_session_settings_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    html.extract(spark.createDataFrame([("a",)], "html string")).collect()
    assert spark.conf.get(key) == before


def test_steps_are_cut_by_bytes_and_rows(monkeypatch):
    import pyarrow as pa

    from lexweave.llm import common

    monkeypatch.setattr(common, "STEP_BYTES", 100)
    monkeypatch.setattr(common, "STEP_ROWS", 4)
    texts = ["x" * n for n in (10, 95, 1, 500, 0, 0, 0, 0, 0, 30, 30, 60)] + [None]
    parts = [p.column(0).to_pylist() for p in common.steps([pa.RecordBatch.from_pydict({"t": texts})], "t")]
    assert sum(parts, []) == texts and all(len(p) <= 4 and (len(p) == 1 or sum(len(x or "") for x in p) <= 100) for p in parts)
