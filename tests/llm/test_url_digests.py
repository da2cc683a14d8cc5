import numpy as np

from clickloom.llm.queries import URL_RULES
from clickloom.llm.url_digests import Digests, digest_array, judged, judged_by_join

URLS = [None, "", "no scheme", "http://", "https://A.B.Example.ORG/en/1", "http://example.org/en/12?x", "http://example.org/es/",
        "http://example.org/es", "http://example.org", "http://badexample.org/es/x", "ftp://shop.com/fr/a#b", "http://com/de/",
        "http://x.com/de/", "HTTP://x.com/DE/", "a://b://c.org/", "http://x.org?q=/", "http://ÄÖ.org/ü", "http://x.com:80/fr/",
        "http://u@x.com/fr/", "x://org/\nnew", "http://" + "a." * 3000 + "com/fr/"]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for rule, verdict in URL_RULES:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, *(best or (None, "allow"))


def test_rules_against_plain_python(spark):
    rows = [(k, u, "r") for k, u in enumerate(URLS)] + [(0, None, "r"), (None, "http://a.org/", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    wanted = sorted((str((k, *plain(u))) for k, u, _ in rows))
    assert sorted(str(tuple(r)) for r in judged(df, URL_RULES).collect()) == wanted
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    assert sorted(str(tuple(r)) for r in judged_by_join(df, rules).collect()) == wanted
    assert judged(df.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in judged(df, [], default="block").collect()} == {"block"}


def test_colliding_digests_are_told_apart_by_their_strings(monkeypatch):
    import xxhash
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda text: len(text) % 2)
    rules = [(f"h{k}.org/{'p' * (k % 5)}", "block" if k % 3 else "allow") for k in range(50)]
    array = Digests(digest_array(rules))
    assert (np.diff(array.keys.astype(np.int64)) >= 0).all()
    found = array.find([r.encode() for r, _ in rules] + [b"h1.org/", b"absent/"])
    assert [array.rule(k).decode() for k in found[:50]] == [r for r, _ in rules]
    assert [bool(array.block[k]) for k in found[:50]] == [v == "block" for _, v in rules]
    assert found[-1] == -1
