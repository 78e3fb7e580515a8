"""URL rules against plain Python."""

import random
import tracemalloc

import pytest

from tillmart.llm import url_filter
from tillmart.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.org/es/x?y", "http://example.org/en/123", "https://sub.example.org/en/1#t",
    "http://example.org", "http://org/", "http://notorg/x", "http://a.com/fr/1", "http://a.com/de/", "http://a.com/de", "http://.com/fr/",
    "http://a.com?x=/fr/", "http://x/y://a.com/de/", "http://ÀB.com/FR/", "http://a.com/fr/" + "é" * 10_000, "http://b..org/es/", "ftp://com/de/#",
]


def plain(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        at = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
        path = rest[at:].split("?")[0].split("#")[0]
    best = None
    for verdict, rule in rules:
        of_host, of_path = rule.split("/", 1)
        if (host == of_host or host.endswith("." + of_host)) and path.startswith("/" + of_path):
            best = max(best or (0,), (len(rule), len(of_host), rule, verdict))
    return host, path, best[2] if best else None, best[3] if best else "allow"


@pytest.mark.parametrize("rules", [URL_RULES, ()])
def test_urls(spark, rules):
    pages = spark.createDataFrame([(n, u, "x") for n, u in enumerate(URLS)] + [(None, URLS[5], "x")] * 2, "page_id bigint, url string, verdict string")
    found = url_filter.judged(spark, pages, rules).collect()
    assert len(found) == len(URLS) + 2
    for row in found:
        assert tuple(row)[1:] == plain(URLS[5 if row.page_id is None else row.page_id], rules)
    assert url_filter.judged(spark, pages.limit(0), rules).collect() == []


def test_hosts_of_very_many_labels(tmp_path):
    rules = [*URL_RULES, ("block", "x.y.z.w/")]
    url_filter.write_array(rules, str(tmp_path / "rules.bin"))
    array = url_filter.DigestArray(str(tmp_path / "rules.bin"))
    urls = [f"http://{'a.' * 100_000}{end}" for end in ("com/fr/", "example.org/es/1", "y.z.w/", "x.y.z.w/", "x.y.z.w./")]
    tracemalloc.start()
    try:
        found = array.judge([url_filter.split_url(u) for u in urls])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [r for r, _ in found] == ["com/fr/", "example.org/es/", None, "x.y.z.w/", None]
    assert peak < 20_000_000


def test_many_rules_and_collisions(tmp_path, monkeypatch):
    draw = random.Random(4)
    rules = {f"h{draw.randrange(40)}.{draw.choice(['com', 'org'])}/{draw.choice(['', 'a', 'ab/', 'abc'])}": draw.choice(["allow", "block"]) for _ in range(300)}
    urls = [f"http://{draw.choice(['', 'w.'])}h{draw.randrange(50)}.{draw.choice(['com', 'org'])}/{draw.choice(['', 'a', 'abcd', 'ab/c'])}" for _ in range(500)]
    listed = [(v, r) for r, v in rules.items()]
    few = url_filter.xxhash.xxh64_intdigest
    for digest in (few, lambda data: few(data) % 8):  # with 8 digests nearly all collide
        monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", digest)
        url_filter.write_array(listed, str(tmp_path / "rules.bin"))
        array = url_filter.DigestArray(str(tmp_path / "rules.bin"))
        for url, (rule, verdict) in zip(urls, array.judge([url_filter.split_url(u) for u in urls])):
            assert (rule, "block" if verdict else "allow") == plain(url, listed)[2:]


def test_rules_without_a_path_are_refused(tmp_path):
    with pytest.raises(ValueError):
        url_filter.write_array([("allow", "example.org")], str(tmp_path / "x"))
