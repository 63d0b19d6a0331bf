"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF

from spokeline.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
COLUMNS = "doc_id long, text string, word string, n long, key string, root string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """Words that share a form with one code point left out, or whose forms equal the other; then checked."""
    by = {}
    for w in words:
        for form in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by.setdefault(form, set()).add(w)
    out = {w: set() for w in words}
    for group in by.values():
        for a in group:
            out[a] |= {b for b in group if b not in out[a] and near(a, b)}
    return out


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    nears, form = neighbours(words), {}
    for w in words:
        top = min(nears[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 2 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(nears[w]), words.get(form[w])))
    return out


def found(docs):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in spelling.spelling_variants(docs).select(columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in rows], COLUMNS)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [tuple(r) for r in spelling.op13_spelling_variants(spark, SF).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute([(r.doc_id, r.text) for r in docs])


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "abéÿ×À"])
def test_dense_vocabularies_in_many_parts(spark, monkeypatch, letters):
    """Blocks of a few words, split in parts; chains of forms; one word holding a third of all runs."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 40)
    monkeypatch.setattr(spelling, "CHUNK", 16)
    rnd = random.Random(len(letters))
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(5, 10))) for _ in range(300)]
    chain = ["abcdefghijk"[: 5 + n] for n in range(6)]
    rows = [(n, " ".join(rnd.choices(words, k=8) + [words[0].upper()] * 4)) for n in range(250)]
    rows += [(1000 + n, f"{w}, " * 3 * 3**n) for n, w in enumerate(chain)]
    assert found(table(spark, rows)) == brute(rows)


def test_edges(spark):
    long = "ab" * 3000
    rows = [(None, "alpha Alpha ALPHA alphas alphas alphas"), (None, None), (3, ""), (4, long), (4, long), (5, long),
            (6, long + "c"), (6, long + "c"), (7, f"{long}c z" + long + "ő" + long), (8, "Šalpha ××××× " * 3)]
    assert found(table(spark, rows)) == brute(rows)
    assert found(table(spark, [])) == set()
