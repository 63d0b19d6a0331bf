"""URL rules and suffix statistics against plain loops."""

from spokeline.llm import urls

HOSTS = ["a.org", "example.org", "B.Example.ORG", "x.com", "com", "q.net", "", "org", "aorg"]
PATHS = ["", "/", "/es/", "/es/1?x", "/en/1", "/en/19#t", "/fr/", "/fr", "/de/?a", "/de/1/2", "?q=/de/", "#/es/"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i, c in enumerate(rest) if c in "/?#"], default=len(rest))
    path = rest[end:]
    return rest[:end].lower(), path[: min([i for i, c in enumerate(path) if c in "?#"], default=len(path))]


def test_rules_against_a_loop(spark):
    given = [f"{s}://{h}{p}" for s in ("http", "https") for h in HOSTS for p in PATHS] + [None, "", "no", "a://b://org/"]
    rows = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    model = urls.train(spark.createDataFrame([], "url string, bad int"))
    judged = urls.judge(rows, urls.RULES, model).collect()
    assert len(judged) == len(given)
    for r in judged:
        host, path = split(r.url)
        fits = []
        for rule, says in urls.RULES:
            name, _, start = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
                fits.append((len(rule), rule, says))
        rule, says = max(fits)[1:] if fits else (None, r.verdict)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, says)


def test_suffix_statistics_count_all_and_leave_out_the_own_part(spark, monkeypatch):
    monkeypatch.setattr(urls, "FIT_ROWS", 5)
    given = [(f"http://h{n % 3}.d{n % 4}.{['org', 'net'][n % 2]}/{n}", int(n % 7 < 3)) for n in range(200)]
    given += [("http://org/1", 1), (None, 0), ("http://h0.d0.org/0", 1)]
    labelled = spark.createDataFrame(given, "url string, bad int")
    folds = {r.url: r.fold for r in labelled.select("url", urls._fold().alias("fold")).collect()}
    expected = {}
    for url, bad in given:
        host = split(url)[0]
        for suffix in (host.split(".")[-1], ".".join(("." + host).split(".")[-2:]) if "." in host else "." + host):
            for without in (-1, *range(urls.FOLDS)):
                if without != folds[url]:
                    n_bad, n = expected.get((suffix, without), (0, 0))
                    expected[suffix, without] = n_bad + bad, n + 1
    _, suffixes, average = urls.train(labelled)
    assert {(r.suffix, r.without): (r.n_bad, r.n) for r in suffixes.collect()} == expected
    assert average == sum(bad for _, bad in given) / len(given)
