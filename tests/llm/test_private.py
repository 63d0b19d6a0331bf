"""Personal data in dense texts of many pieces, against plain loops, and columns with clashing names."""

import re

from pyspark.sql import functions as F

from spokeline.llm import private

DENSE = "é😀 10.1.2.3 key=abcDEF123456xyz call 555-123-4567, a@b.org a@b.org; " * 700 + "z" * 600


def test_running_results_and_binary_search(spark):
    values = [(n * 7919) % 1000 for n in range(private.CHUNK * 3 + 5)]
    rows = spark.createDataFrame([(values,), ([],), ([5],)], "v array<long>")
    sums = [r[0] for r in rows.select(private._running(F.col("v"), lambda a, b: a + b)).collect()]
    tops = [r[0] for r in rows.select(private._running(F.col("v"), F.greatest)).collect()]
    assert sums == [[sum(values[: i + 1]) for i in range(len(values))], [], [5]]
    assert tops == [[max(values[: i + 1]) for i in range(len(values))], [], [5]]
    rows = spark.createDataFrame([(s, b) for s in ([], [3], [1, 1, 4, 9, 9, 9, 12]) for b in range(14)], "v array<long>, b long")
    for r in rows.select("v", "b", private._below(F.col("v"), F.col("b")).alias("n")).collect():
        assert r.n == sum(x < r.b for x in r.v)


def test_parts_of_blocks(spark):
    text = "".join(chr(97 + n % 26) + "é😀"[n % 2] for n in range(private.BLOCK * 2))
    ends = [0, 1, 511, 512, 513, 1023, 1024, 1500, len(text)]
    rows = spark.createDataFrame([(text, a, b) for a in ends for b in ends if a <= b], "text string, a long, b long")
    rows = rows.withColumn("blocks", private._blocks(F.col("text")))
    for r in rows.select("a", "b", private._cut(F.col("blocks"), F.col("a"), F.col("b")).alias("cut")).collect():
        assert r.cut == text[r.a : r.b]


def test_dense_text_against_plain_loops(spark):
    docs = spark.createDataFrame(
        [(1, DENSE, 7, "x"), (1, DENSE, 7, "x"), (None, None, None, None), (3, "10.1.2.3", 8, "y")],
        "doc_id long, text string, row long, loose string",
    ).withColumn("tops", F.lit(1)).withColumn("base", F.lit("b"))
    found = private.find_private(docs)
    rows = found.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "3", "None"]
    assert {(r.row, r.loose, r.tops) for r in rows} == {(7, "x", 1), (None, None, 1), (8, "y", 1)}
    dense = next(r for r in rows if r.doc_id == 1)
    plain = {"email": r"a@b\.org", "ip": r"10\.1\.2\.3", "secret": "abcDEF123456xyz"}
    for kind, pattern in plain.items():
        expected = [(m.start(), m.end()) for m in re.finditer(pattern, DENSE)]
        assert [(s.start, s.end) for s in dense.spans if s.kind == kind] == expected
    for before, after in zip(dense.spans, dense.spans[1:]):
        assert before.end <= after.start
    out, at = "", 0
    for s in dense.spans:
        out, at = out + DENSE[at : s.start] + f"[{s.kind.upper()}]", s.end
    cleared = {r.doc_id: (r.text, r.row) for r in private.redact(found).collect()}
    assert cleared == {1: (out + DENSE[at:], 7), None: ("", None), 3: ("[IP]", 8)}


def test_spans_that_overlap_become_one_stretch(spark):
    schema = "text string, spans array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
    spans = [(2, 0, "email", 9), (4, 1, "ip", 6), (5, 2, "card", 11), (11, 3, "phone", 12)]
    rows = spark.createDataFrame([("ab" + "c" * 12, spans), ("q", []), ("wxyz", [(0, 0, "email", 4)])], schema)
    assert [r.text for r in private.redact(rows).collect()] == ["ab[EMAIL][PHONE]cc", "q", "[EMAIL]"]


def test_all_candidates_count_in_the_fit(spark, monkeypatch):
    seen, fit = [], private.fit
    monkeypatch.setattr(private, "fit", lambda *given: seen.append(given) or fit(*given))
    words = [f"ab{n:06d}cdef" for n in range(26000)]
    texts = [" ".join(words[n : n + 500]) for n in range(0, 26000, 500)]
    docs = spark.createDataFrame([(x,) for x in [*texts, "key=abcDEF123456xyz", "key=abcDEF123456xyz"]], "text string")
    marked = private.with_candidates(docs)
    by_label = {r.label: r.n for r in private.cells(marked).groupBy("label").agg(F.sum("n").alias("n")).collect()}
    assert by_label == {0: 26000, 1: 2}
    private.train(marked)
    ((inputs, labels, counts, cuts),) = seen
    assert 12000 < counts[labels == 0].sum() < 14500 and len(inputs) < 1000
    # What a cell stands for lies in it.
    span = spark.createDataFrame([("see AKIAabcdef12345678 there",)], "text string")
    span = private.with_candidates(span).select(F.explode("loose").alias("span"))
    values = span.select(*private._features(F.col("span"))).first()
    cell = private.cells(private.with_candidates(spark.createDataFrame([("see AKIAabcdef12345678 there",)], "text string")))
    (back,) = private._inputs(private.np.array([cell.first().cell]))
    assert all(((v > c) == (b > c)).all() for v, b, c in zip(values, back, private.CUTS, strict=True))
