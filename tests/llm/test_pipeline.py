"""The pipeline's stages, each on rows with null, repeated and clashing values."""

import pytest
from conftest import SF

import corpus_pipeline
from spokeline.llm.mixing import mix

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, size long, row long, key string, taken long, n int"


def table(spark, *rows):
    return spark.createDataFrame([(i, t, None, s, None, 1, 2, "k", 3, 4) for i, t, s in rows], EXTRA)


def shown(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def item(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").where("text IS NOT NULL").collect()
    return max((r.text for r in items), key=len)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_tables(spark, name, stage):
    docs = table(spark).limit(0)
    assert stage(spark, docs, SF).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_columns(spark, name, stage):
    assert stage(spark, table(spark, (1, "a b c", "s")), SF).columns == corpus_pipeline.COLUMNS


def test_quality_judges_every_row(spark):
    rows = [(None, "x", "s"), (None, "x", None), (5, None, "s"), (5, "", "s"), (5, "y " * 20_000, "s")]
    found = shown(corpus_pipeline.quality(spark, table(spark, *rows), SF))
    assert set(found) <= {tuple(r) for r in rows} and len(found) <= len(rows)
    twice = shown(corpus_pipeline.quality(spark, table(spark, *rows, *rows), SF))
    assert twice == sorted(found * 2, key=repr)


def test_near_dedup_and_odd_ids(spark):
    a, b = (" ".join(f"{x}{n}" for n in range(50)) for x in "ab")
    rows = [(None, a, "s"), (None, a, "s"), (3, a, None), (2, a + " z", "s"), (5, b, "s"), (5, b, "s"), (7, None, "s"), (9, "", "s")]
    kept = [(None, a, "s"), (None, a, "s"), (2, a + " z", "s"), (5, b, "s"), (5, b, "s"), (7, None, "s")]
    assert shown(corpus_pipeline.near_dedup(spark, table(spark, *rows), SF)) == sorted(kept, key=repr)


def test_decontamination_judges_every_row(spark, item):
    rows = [(None, item, "s"), (None, "clean words only", "s"), (5, "also clean", "s"), (5, f"x {item} y", None),
            (6, None, "s"), (6, "", "s"), (7, "w " * 20_000 + item, "s"), (8, "clean", "s"), (8, "clean", "s")]
    kept = [r for r in rows if item not in (r[1] or "")]
    assert shown(corpus_pipeline.decontaminate(spark, table(spark, *rows), SF)) == sorted(kept, key=repr)


def test_private_data_keeps_every_row(spark):
    rows = [(None, "me@mail.org here", "s"), (None, "me@mail.org here", "s"), (5, None, "s"), (5, "", None), (5, "y " * 20_000, "s")]
    found = shown(corpus_pipeline.private_data(spark, table(spark, *rows), SF))
    assert len(found) == 5 and [t for i, t, _ in found if i is None] == ["[EMAIL] here"] * 2


@pytest.mark.parametrize("backwards", [False, True])
def test_mixing_neither_loses_nor_doubles_rows(spark, backwards):
    rows = [(None, "a b c", "s"), (5, "d e f", "s"), (5, "g h i", "s"), (6, "j k", None), (6, "j k", None), (None, None, "s"),
            (None, "a b c", "s"), (7, "", None), (8, "l " * 5000, "t")]
    docs = table(spark, *(rows[::-1] if backwards else rows))
    found = corpus_pipeline.mixing(spark, docs, SF)
    expected = sorted((r.doc_id or 0, r.size, r.taken) for r in mix(docs).collect() if r.taken)
    assert sorted((r.doc_id or 0, r.size, r.taken) for r in found.collect()) == expected
    assert len(shown(found)) >= 6 and set(shown(found)) <= {tuple(r) for r in rows}
    assert all(len((r.text or "").split()) == r.size for r in found.collect())
