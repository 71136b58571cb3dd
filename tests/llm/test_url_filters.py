from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from strata.llm import url_filters as uf
from strata.llm.common import written

DAY = datetime(2024, 1, 1)


def keys_of(spark, url):
    df = spark.createDataFrame([(url,)], "url string")
    return df.select(uf.url_keys(F.col("url"))).first()[0]


def test_keys(spark):
    assert keys_of(spark, "HTTPS://me:pw@A.b.Example.COM.:8080/x//y/z/w?q=/a#f") == [
        "d:a.b.example.com", "d:b.example.com", "d:example.com", "d:com", "p:a.b.example.com/x", "p:a.b.example.com/x/y", "p:a.b.example.com/x/y/z",
        "p:a.b.example.com/x/y/z/w",
    ]
    df = spark.createDataFrame([("http://a.example.com/x/y",)], "url string")
    assert df.select(uf.url_keys(F.col("url"), 1, False)).first()[0] == ["d:a.example.com", "d:example.com", "p:a.example.com/x"]
    assert keys_of(spark, "http://localhost") == ["d:localhost"]
    for bad in (None, "", "no url", "mailto:x@y", "http:///path"):
        assert keys_of(spark, bad) == []


def test_addresses_are_whole(spark):
    assert keys_of(spark, "http://[2001:DB8::1]:8080/x") == ["d:[2001:db8::1]", "p:[2001:db8::1]/x"]
    assert keys_of(spark, "http://me@10.0.0.1:80/") == ["d:10.0.0.1"]
    assert keys_of(spark, "http://10.0.0.1.example/") == ["d:10.0.0.1.example", "d:0.0.1.example", "d:0.1.example", "d:1.example", "d:example"]
    c = spark.createDataFrame([(1, "http://10.0.0.1/a", DAY), (2, "http://[2001:db8::1]/x", DAY)], "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame([("l", k, "add", DAY) for k in ("d:0.1", "d:1", "d:[2001:db8::1]")], "list string, key string, action string, at timestamp")
    assert {(r["page_id"], r["entry"]) for r in uf.evaluate(c, e).collect()} == {(1, None), (2, "d:[2001:db8::1]")}


def test_an_outlier_date_adds_one_span(spark):
    far = datetime(1900, 1, 1)
    captures = [(i, "http://a.com", DAY + timedelta(days=i)) for i in range(3)] + [(9, "http://a.com", far)]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame([("l", "d:a.com", "add", datetime(1899, 1, 1)), ("l", "d:b.com", "add", DAY)], "list string, key string, action string, at timestamp")
    assert all(r["blocked"] for r in uf.evaluate(c, e).collect())
    spans = sorted(r[0] for r in c.select(uf._span(F.col("fetched_at"))).distinct().collect())
    assert len(spans) == 2
    copies = uf.copied(uf.validity_intervals(e), spans)
    assert {(r["key"], r["n"]) for r in copies.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()} == {("d:a.com", 2 * uf.SALTS), ("d:b.com", uf.SALTS)}
    assert copies.filter("false").count() == uf.copied(uf.validity_intervals(e), []).count() == 0


def test_copied_intervals_do_not_pass_through_the_driver(spark):
    captures = [(i, f"http://h{i % 40}.com/{i}", DAY + timedelta(days=i)) for i in range(300)]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp")
    log = spark.range(2000).selectExpr("'l' AS list", "concat('d:h', id, '.com') AS key", "'add' AS action", "timestamp'2023-01-01 00:00:00' AS at")
    got = uf.evaluate(c, written(log, "test-url-entries"))  # files of a few KB, hundreds of thousands of copies
    assert [(r["n_active"], r["entry"]) for r in got.orderBy("page_id").collect()] == [(1, f"d:h{i % 40}.com") for i in range(300)]
    query = got._jdf.queryExecution()
    for plan in (query.sparkPlan(), query.executedPlan()):
        joins = [x for x in plan.toString().splitlines() if "Join" in x and "salt#" in x]
        assert joins and all("SortMergeJoin" in x for x in joins)


def brute(captures, entries):
    state = {}
    for e in entries:
        if None not in e and e[2] in ("add", "remove"):
            state.setdefault((e[0], e[1]), {}).setdefault(e[3], set()).add(e[2])
    out = []
    for i, url, t, keys in captures:
        active = []
        for (name, key), log in state.items():
            if t is None or key not in keys:
                continue
            on, since = False, None
            for at in sorted(x for x in log if x <= t):
                now = log[at] == {"add"}
                since = at if now and not on else since
                on = now
            if on:
                active.append((-len(key), name, key, since))
        best = min(active, default=(None,) * 4)
        out.append((i, url, t, len(active), ",".join(sorted({a[1] for a in active})), best[2], best[3], bool(active)))
    return sorted(out, key=str)


def test_as_of_join_against_brute_force(spark):
    rng = random.Random(3)
    hosts = ["a.example.com", "b.example.com", "example.com", "other.org", "hot.net"]
    captures = []
    for i in range(400):
        h = "hot.net" if i % 3 == 0 else rng.choice(hosts)
        captures.append((i % 350 or None, f"http://{h}/{rng.choice('xy')}/{rng.randrange(3)}", DAY + timedelta(hours=rng.randrange(24 * 300))))
    captures += [(1, None, DAY), (2, "http://example.com/x/1", None), (3, "nothing", DAY), captures[5], captures[5]]
    keys = ["d:example.com", "d:a.example.com", "d:hot.net", "p:hot.net/x", "p:hot.net/x/1", "d:org"]
    entries = [(rng.choice(["l1", "l2"]), rng.choice(keys), rng.choice(["add", "remove"]), DAY + timedelta(days=rng.randrange(-50, 320))) for _ in range(120)]
    entries += [entries[0], (None, "d:example.com", "add", DAY), ("l1", "d:hot.net", "noise", DAY), ("l3", "d:hot.net", "add", None), (*entries[1][:2], "remove", entries[1][3])]
    c = spark.createDataFrame([(*r, "x", "y") for r in captures], "page_id long, url string, fetched_at timestamp, key string, list string")
    e = spark.createDataFrame(entries, "list string, key string, action string, at timestamp")
    got = sorted(map(tuple, uf.evaluate(c, e).collect()), key=str)
    by_url = {r["url"]: set(r["k"]) for r in c.select("url", uf.url_keys(F.col("url")).alias("k")).distinct().collect()}
    with_keys = [(i, u, t, by_url[u]) for i, u, t in captures]
    assert got == brute(with_keys, entries)
    assert sum(r[-1] for r in got) > 50


def test_no_entries(spark):
    c = spark.createDataFrame([(1, "http://a.com", DAY)], "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame([], "list string, key string, action string, at timestamp")
    assert [r["blocked"] for r in uf.evaluate(c, e).collect()] == [False]


def covers(key, url):
    """By prefix, on its own: no keys of a URL are made."""
    if "://" not in url:
        return False
    rest = url.split("://", 1)[1].split("?", 1)[0].split("#", 1)[0]
    name, _, path = rest.partition("/")
    path = "/".join(s for s in path.split("/") if s)
    if key.startswith("d:"):
        return f".{name}".endswith("." + key[2:])
    return f"{name}/{path}/".startswith(key[2:] + "/")


def test_deep_paths_and_last_labels_against_prefixes(spark):
    rng = random.Random(7)
    urls = ["nothing"] + [f"http://{h}/" + "/".join(rng.choice("ab") for _ in range(rng.randrange(9))) + q for h in ("x.org", "y.x.org", "z.com") for q in ("", "?q=/a", "/") for _ in range(25)]
    captures = [(i, u, DAY + timedelta(days=rng.randrange(100))) for i, u in enumerate(urls)]
    keys = ["d:org", "d:com", "d:x.org", "d:rg", "p:x.org", "p:z.com/a/b/", "p:x.org/a"] + ["p:x.org/" + "/".join(rng.choice("ab") for _ in range(n)) for n in (4, 4, 4, 5, 5, 5, 8)]
    keys += [k for u in urls if (k := "p:" + u.split("://")[-1].split("?")[0].rstrip("/")).count("/") > 4][:20]
    entries = [(rng.choice(["l1", "l2"]), k, "add", DAY + timedelta(days=rng.randrange(60))) for k in keys]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame(entries, "list string, key string, action string, at timestamp")
    for last_label in (False, True):
        # A bare host is no path key, and a last label alone counts only on demand.
        of = {u: {k for k in keys if covers(k, u) and (k[0] == "d" or "/" in k) and not k.endswith("/") and (last_label or "." in k)} for u in urls}
        got = sorted(map(tuple, uf.evaluate(c, e, last_label=last_label).collect()), key=str)
        assert got == brute([(i, u, t, of[u]) for i, u, t in captures], entries)
        assert sum(r[5] is not None and r[5].count("/") > 3 for r in got) > 10
    assert sum(r[5] == "d:com" for r in got) > 10
