"""Operators against plain loops that follow their definitions, on random input."""

import random
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from test_llm import documents

from spokeline.llm import fingerprints, mixing, tokencounts, urls, words

MASK = 2**64 - 1


def toss(left, right):
    """The lowest differing bit of two symbols, and that bit of the right one."""
    lowest = ((left ^ right) & -(left ^ right)).bit_length() - 1
    return 0 if left == right else 2 * lowest + ((right >> lowest) & 1)


def tossed(symbols):
    return [symbols[0] & 1] + [toss(a, b) for a, b in zip(symbols, symbols[1:], strict=False)]


def plain_parse(data):
    runs = [(symbol, len(list(group))) for symbol, group in groupby(data)]
    names = [int(fingerprints._symbols[s]) * n & MASK for s, n in runs]
    labels, levels = tossed([s for s, _ in runs]), []
    for level in range(1, fingerprints.LEVELS + 1):
        labels = tossed(tossed(labels))
        cuts = [0] + [i for i in range(1, len(labels) - 1) if labels[i - 1] < labels[i] > labels[i + 1]] + [len(labels)]
        phrases = [names[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        sums = [sum(x * words._BASES[0] ** i for i, x in enumerate(p)) + len(p) * (2 * level + 1) for p in phrases]
        levels.append([int(words.mix(np.array([x & MASK], dtype=np.uint64))[0]) for x in sums])
        names = [(x + len(list(group)) - 1) & MASK for x, group in groupby(levels[-1])]
        labels = tossed(tossed(names))
    return levels


def test_parse():
    rnd = random.Random(12)
    texts = ["", "a", "ab", "aaaa", "é" * 9, "abab" * 40, None]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(400))) for letters in ("ab", "abcdefgh \n", "äöü€x") * 8]
    found = fingerprints.parse(pa.array(texts, pa.string()))
    for n, text in enumerate(texts):
        expected = plain_parse(text.encode()) if text else [[]] * fingerprints.LEVELS
        assert [names[owner == n].tolist() for names, owner in found] == expected


def test_any_limit_and_quantile(spark):
    rnd = random.Random(13)
    lengths = [rnd.choice([0, 1, 5, 9, 2000, 2001, 7777, rnd.randrange(9000)]) for _ in range(300)]
    histogram = spark.createDataFrame([(n, lengths.count(n)) for n in set(lengths)], "n_tokens long, n_docs long")
    sums = tokencounts.with_suffix_sums(histogram)
    limits = [0, 1, 2, 5, 6, 1023, 1024, 2000, 2001, 5000, 8999, 10**6]
    totals = {r.limit: r.total for r in tokencounts.truncated_totals(sums, limits).collect()}
    assert totals == {limit: sum(min(n, limit) for n in lengths) for limit in limits}
    shares = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    ordered = sorted(lengths)
    expected = {q: min(n for i, n in enumerate(ordered, 1) if i / len(ordered) >= q) for q in shares}
    assert {r.share: r.n_tokens for r in tokencounts.quantiles(sums, shares).collect()} == expected
    empty = tokencounts.with_suffix_sums(histogram.limit(0))
    assert [r.total for r in tokencounts.truncated_totals(empty, [3]).collect()] == [0]
    assert [r.n_tokens for r in tokencounts.quantiles(empty, [0.5]).collect()] == [None]


def filled(sizes):
    """Targets of sources, None last: 150% of all sizes by weights 3, 1, 2, at most twice a source's."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, rest = {}, Fraction(3 * sum(sizes.values()), 2)
    while True:
        open_ = [s for s in order if s not in full]
        each = rest / (sum(weight[s] for s in open_) or 1)
        over = [s for s in open_ if each * weight[s] > 2 * sizes[s]]
        if not over:
            return full | {s: each * weight[s] for s in open_}
        full |= {s: Fraction(2 * sizes[s]) for s in over}
        rest -= sum(full[s] for s in over)


def test_mix_targets(spark):
    rnd = random.Random(14)
    sources = ["a", "B", "é", "", None, "z", "zz", "b"]
    rows = [(n, "w " * rnd.choice([0, 1, 7, rnd.randrange(900)]), rnd.choice(sources[: 1 + n % 8])) for n in range(200)]
    found = mixing.mix(documents(spark, *rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text) // 2
    expected = filled(sizes)
    assert len(found) == len(rows)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - float(expected[r.source])) < 1e-6 and r.taken <= 2 * r.size
    for source, target in expected.items():
        assert abs(sum(r.taken for r in found if r.source == source) - target) <= 1


def test_url_rules(spark):
    rnd = random.Random(15)
    labels, paths = ["a", "b", "xa", "org"], ["/", "/e", "/en/", "/en/1", "/en/12", ""]
    pick = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randrange(1, 4)))
    rules = tuple({(pick(), rnd.choice(["/", "/e", "/en/1"])): rnd.choice(["allow", "block"]) for _ in range(12)}.items())
    rules = tuple((host + path, verdict) for (host, path), verdict in rules)
    made = [rnd.choice(["http://", "https://", "x://y://", ""]) + pick().replace("a", rnd.choice("aA")) + rnd.choice(paths)
            + rnd.choice(["", "?q=/en/1", "#t", "/x"]) for _ in range(300)] + [None, "", "://", "http:///en/1"]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string")

    def plain(url):
        if url is None or "://" not in url:
            return "", "", None, None
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:end].lower(), rest[end:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        fits = [(len(rule), rule, verdict) for rule, verdict in rules
                if ("." + host).endswith("." + rule[: rule.index("/")]) and path.startswith(rule[rule.index("/") :])]
        return host, path, *(max(fits)[1:] if fits else (None, None))

    model = urls.train(spark.createDataFrame([], "url string, bad int"))
    for r in urls.judge(pages, rules, model).collect():
        host, path, rule, verdict = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (rule is None or r.verdict == verdict)


def test_exact_name_sets(spark):
    rnd = random.Random(16)
    write = lambda n: "".join(rnd.choice("abcdefghijk lmnop") for _ in range(n))
    passage = write(3000)
    texts = {1: write(150_000) + passage + write(150_000), 2: write(80_000) + passage + write(200_000), 3: write(9000),
             4: None, 5: "", None: passage, 6: "ab"}
    docs = documents(spark, *((i, t, "s") for i, t in texts.items()), (3, texts[3], "t"))
    pairs = [(1, 2), (1, None), (1, 3), (4, 5), (3, 3), (1, 9), (3, 1), (1, 2), (6, 6)]
    names = fingerprints.name_sets(docs)
    rows = fingerprints.exact_likeness(spark.createDataFrame(pairs, "a long, b long"), names).collect()
    sets = {i: {(n, x) for n, level in enumerate(plain_parse(t.encode()), 1) if n > 1 for x in level} if t else set()
            for i, t in (texts | {9: ""}).items()}
    assert sorted(map(str, rows)) == sorted({str(r) for r in rows}) and len(rows) == len(set(pairs))
    for r in rows:
        a, b = sets[r.a], sets[r.b]
        assert (r.n_a, r.n_b, r.n_common) == (len(a), len(b), len(a & b))
        assert r.jaccard == (len(a & b) / len(a | b) if a | b else 0) and r.contained == (len(a & b) / min(len(a), len(b)) if a and b else 0)
    found = {(r.a, r.b): r for r in rows}
    assert found[1, 2].n_common > 100 and found[1, None].contained > 0.9 and found[3, 3].jaccard == 1 and found[1, 3].contained < 0.2
    assert fingerprints.name_sets(docs.limit(0)).collect() == []
