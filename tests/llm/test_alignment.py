"""Token alignment against a plain computation from the tokenizers' own libraries."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers
from conftest import SF

from spokeline.llm import alignment

COLUMNS = "doc_id long, text string, pair long, part int, slice long, n long"


@pytest.fixture(scope="module")
def spell():
    """Text to (ids, ends) of both, by the whole-file tokenizer and by pieces."""
    by_a = tokenizers.Tokenizer.from_file(alignment.BYTES_A)
    by_a.encode_special_tokens = True
    by_b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES_B)
    letters = alignment._byte_letters()
    token_bytes = {i: bytes(letters[c] for c in t) for t, i in json.load(open(alignment.BYTES_A))["model"]["vocab"].items()
                   if i != 50256}

    def piece_bytes(i):
        name = by_b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if by_b.is_byte(i) else name.replace("▁", " ").encode()

    def run(text):
        if not text:
            return [], []
        a = [(i, token_bytes[i]) for i in by_a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece_bytes(i)) for i in by_b.encode(text)]
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            return [], []
        return a, b

    return run


def groups_of(a, b):
    """Walk both, adding to whichever is behind, and cut where they are even."""
    out, i, j, at_a, at_b, own_a, own_b = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            own_a.append(a[i][0])
            at_a += len(a[i][1])
            i += 1
        else:
            own_b.append(b[j][0])
            at_b += len(b[j][1])
            j += 1
        if at_a == at_b:
            out.append((own_a, own_b))
            own_a, own_b = [], []
    return out


def brute(rows, spell):
    every = []
    for doc_id, text in rows:
        a, b = spell(text)
        every.append((doc_id, a, b, groups_of(a, b)))
    docs, best = Counter(), defaultdict(int)
    links = [Counter((x, y) for g, h in groups for x in g for y in h) for *_, groups in every]
    for own in links:
        docs.update(set(own))
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, a, b, groups), own in zip(every, links, strict=True):
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out.append((doc_id, len(a), len(b), len(groups), sum(own.values()),
                    sum(n for p, n in own.items() if docs[p] == best[p[0]]), sum(n * docs[p] for p, n in own.items()),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


ORDER = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(docs):
    return sorted((tuple(r) for r in alignment.link_statistics(docs).select(ORDER).collect()), key=repr)


def test_query_against_brute_force(spark, spell):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = sorted((tuple(r) for r in alignment.op11_token_alignment(spark, SF).select(ORDER).collect()), key=repr)
    assert rows == brute([(r.doc_id, r.text) for r in docs], spell)


def odd_rows():
    rnd = random.Random(11)
    pool = "ab the 1 2 \n\t▁éß漢한\U0001f642‍ <s></s><unk><0x41><|endoftext|>.=-　\x00\x85"
    rows = [(n, "".join(rnd.choices(pool, k=rnd.randrange(1, 80)))) for n in range(150)]
    rows += [(None, "one two"), (None, "one two"), (5, None), (5, ""), (5, " "), (6, "=" * 3000), (7, "▁"), (8, "\n\n x"),
             (9, "".join(rnd.choices("abcdefgh0123456789", k=20_000))), (10, "the " * 30_000), (11, "漢" * 2000)]
    return rows


def test_odd_texts(spark, spell, monkeypatch):
    rows = odd_rows()
    table = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], COLUMNS)
    assert found(table) == brute(rows, spell)
    assert found(table.limit(0)) == []


def test_small_windows_and_portions(spell, monkeypatch):
    """What bounds memory doesn't change results: windows of ends, runs of links, parts of wide groups."""
    models = alignment.Tokenizers(open(alignment.BYTES_A, "rb").read(), open(alignment.PIECES_B, "rb").read())
    texts = [t for _, t in odd_rows()]
    wide = alignment.align(models, texts)
    assert wide.links.sum() == (wide.size_a * wide.size_b).sum()
    plain = alignment.distinct_links(wide, 32000)
    monkeypatch.setattr(alignment, "WINDOW", 7)
    monkeypatch.setattr(alignment, "LINKS", 3)
    again = alignment.align(models, texts)
    assert all((x == y).all() for x, y in zip(plain, alignment.distinct_links(again, 32000), strict=True))
    for text, (a, b, ends_a, ends_b) in zip(texts, again.tokens, strict=True):
        own = groups_of(*spell(text))
        cut = lambda ids, ends: [ids[x:y].tolist() for x, y in zip([0, *ends], ends, strict=False)]
        assert [list(g) for g in zip(cut(a, ends_a), cut(b, ends_b), strict=True)] == [list(g) for g in own]


def test_wide_groups_are_expanded_in_rows(monkeypatch):
    a, b = np.array([1, 2, 1, 3, 9]), np.array([5, 5, 6, 7])
    found = alignment.Aligned(a, b, np.array([0, 4]), np.array([0, 3]), np.array([4, 1]), np.array([3, 1]), np.array([0, 2]), [])
    plain = Counter((x, y) for x in a[:4].tolist() for y in b[:3].tolist()) + Counter([(9, 7)])
    for links in (1, 2, 5, 100):
        monkeypatch.setattr(alignment, "LINKS", links)
        text, pair, times = alignment.distinct_links(found, 10)
        assert {(p // 10, p % 10): n for p, n in zip(pair.tolist(), times.tolist(), strict=True)} == dict(plain)
        assert not text.any()


def test_aligned_tokens(spark, spell):
    rows = odd_rows()
    table = spark.createDataFrame([(n, t, 1, 2, 3, 4) for n, (_, t) in enumerate(rows)], COLUMNS)
    for r in alignment.aligned_tokens(table).collect():
        a, b = spell(rows[r.doc_id][1])
        assert r.a_ids == [i for i, _ in a] and r.b_ids == [i for i, _ in b] and len(r.a_ends) == len(groups_of(a, b))
