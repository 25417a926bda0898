"""The temporal list join against a plain reading of the changes."""

import datetime as dt

from tripgrid.llm import urlfilter

DAY = dt.datetime(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


CHANGES = [
    ("spam", False, "domain", "bad.com", day(10), True),
    ("spam", False, "domain", "bad.com", day(20), False),
    ("spam", False, "domain", "bad.com", day(400), True),
    ("spam", False, "domain", "tie.org", day(5), False),
    ("spam", False, "domain", "tie.org", day(5), True),
    ("safe", True, "prefix", "bad.com/ok", day(0), True),
    ("odd", False, "prefix", "bad.com/ok/not", day(0), True),
    ("odd", False, "url", "a.bad.com/ok/x?q=1", day(0), True),
    ("safe", True, "domain", "tie.org", day(6), True),
    (None, False, "domain", "bad.com", day(0), True),
    ("never", False, "domain", "good.net", None, True),
    ("later", False, "domain", "good.net", day(10_000), True),
]
CAPTURES = [
    (1, "http://bad.com/", day(9)),
    (2, "http://bad.com/", day(10)),
    (3, "https://user@A.B.BAD.com:8080/x#f", day(19)),
    (4, "http://bad.com", day(20)),
    (5, "http://bad.com/ok", day(15)),
    (6, "http://bad.com/ok/not/this?z", day(15)),
    (7, "http://a.bad.com/ok/x?q=1#y", day(1)),
    (8, "http://notbad.com/", day(15)),
    (9, "http://tie.org/", day(5)),
    (10, "http://tie.org/", day(7)),
    (11, None, day(15)),
    (12, "no url", day(15)),
    (13, "http://bad.com/", None),
    (14, "http://bad.com/", day(500)),
    (15, "http://good.net/", day(600)),
    (15, "http://good.net/", day(600)),
    (None, "http://bad.com/" + "x/" * 2000, day(450)),
]


def brute_force(url, at):
    if url is None or at is None or "://" not in url:
        return False, 0
    rest = url.split("://")[1].split("#")[0]
    host = rest.split("/")[0].split("?")[0].split("@")[-1].split(":")[0].lower()
    after = rest[len(rest.split("/")[0].split("?")[0]) :]
    path = [s for s in after.split("?")[0].split("/") if s]
    best, n = None, 0
    for entry in {c[:4] for c in CHANGES if None not in c}:
        states = sorted((c[4], c[5]) for c in CHANGES if c[:4] == entry and c[4] and c[4] <= at)
        if not states or not states[-1][1]:
            continue
        _, allows, kind, key = entry
        hit = {
            "domain": host == key or host.endswith("." + key),
            "prefix": any(host + "/" + "/".join(path[:k]) == key for k in range(1, len(path) + 1)),
            "url": host + after == key,
        }[kind]
        if hit:
            n += 1
            best = max(best or (), (["domain", "prefix", "url"].index(kind), len(key), allows)) if best else (["domain", "prefix", "url"].index(kind), len(key), allows)
    return bool(best and not best[2]), n


def frames(spark):
    captures = spark.createDataFrame([(*c, "x", 1) for c in CAPTURES], "page_id bigint, url string, fetched_at timestamp, kind string, slot int")
    changes = spark.createDataFrame([(*c, 3) for c in CHANGES], "list string, allows boolean, kind string, key string, changed_at timestamp, listed boolean, row_no int")
    return captures, changes


def test_every_capture(spark):
    out = urlfilter.judge_captures(*frames(spark)).collect()
    got = sorted(((r.page_id or 0), r.blocked, r.n_matches) for r in out)
    assert got == sorted(((i or 0), *brute_force(u, t)) for i, u, t in CAPTURES)
    assert {r.page_id: r.decided_by for r in out}[7] == "odd url a.bad.com/ok/x?q=1"
    assert {r.page_id: r.decided_by for r in out}[1] == ""


def test_empty_tables(spark):
    captures, changes = frames(spark)
    assert urlfilter.judge_captures(captures.where("false"), changes).count() == 0
    assert not any(r.blocked for r in urlfilter.judge_captures(captures, changes.where("false")).collect())
