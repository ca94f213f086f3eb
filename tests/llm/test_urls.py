import random

from pyspark.sql import functions as F

from exactsync.llm import urls
from exactsync.llm.shared import prepare

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
    ("block", "a.com", ""),
    ("allow", "a.com", ""),
    ("allow", "B.a.com", "/x/y/zz"),
    ("block", "b.a.com", "/x/y/z"),
    ("block", "b.a.com", "/x/y"),
    ("allow", "b.a.com", "/x/y/zz/"),
    ("other", "net", "/"),
    ("block", "net", "nothing starts so"),
]
URLS = [
    None, "", "no scheme", "http://", "http:///", "http://ORG", "http://org/", "http://org?x=/y", "http://a.org/b#c",
    "http://Example.ORG/es", "http://www.example.org/es/1", "http://example.org/en/1", "http://example.org/en/12/3",
    "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/1", "http://com/de/", "http://x.com/DE/",
    "x://y://com/de/", "http://a.com", "http://a.com/q", "http://b.a.com/x/y/z", "http://b.a.com/x/y/zz", "http://b.a.com/x/y/zz/",
    "http://c.b.a.com/x/y/zzz/1", "http://b.a.com/x/yy/zz", "http://ba.com/x/y", "http://x.net/", "http://.org/", "http://org./",
    "http://a..org/\n?", "http://É.com/de/É", "http://com:80/de/", "http://u@com/de/", "http://x.com//de/", "http://x.com/" + "s/" * 5000,
]


def slow(url, rules, default):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for verdict, h, p in rules:
        h, p = (h or "").lower(), p or ""
        if verdict in ("allow", "block") and (not h or host == h or host.endswith("." + h)) and path.startswith(p):
            strength = (len(h.split(".")) if h else 0, len(p), verdict == "block", h + p, verdict)
            best = strength if best is None else max(best, strength)
    return host, path, best and best[3], best[4] if best else default


def both(spark, rows, rules, default="allow"):
    prepare(spark)
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("x") for c in ("host", "path", "rule", "found", "number", "a.b", "verdict")}
    )
    entries = urls.entries_of(spark, rules)
    want = sorted([(n, *slow(u, rules, default)) for n, u in rows], key=str)
    for limits in ({}, {"trie_entries": 0}, {"trie_bytes": 0}):
        got = urls.judge(pages.repartition(3), entries, default, **limits)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(map(tuple, got.collect()), key=str) == want, limits


def test_rules_of_all_kinds(spark):
    both(spark, [*enumerate(URLS), (3, URLS[3]), (None, "http://org/")], RULES)
    both(spark, list(enumerate(URLS)), [("block", None, None), ("allow", "org", "/")], "block")


def test_empty_tables(spark):
    both(spark, [], RULES)
    both(spark, list(enumerate(URLS)), [], "block")


def test_random_rules(spark):
    rng = random.Random(3)
    host = lambda: ".".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    path = lambda: "".join(rng.choice("/xy") for _ in range(rng.randint(0, 6)))
    rules = [(rng.choice(("allow", "block")), host(), "/" + path()) for _ in range(60)]
    both(spark, [(n, f"http://{host()}/{path()}") for n in range(600)], rules)
