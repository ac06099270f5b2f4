"""Log tokens, fingerprints and clusters."""

import pytest
from pyspark.sql import functions as F

from sparktel.operators.logclusters import Clusterer, Tenants, with_clusters
from sparktel.operators.logtokens import deep_keys, find_json, fingerprint, hide_quotes, lookup, tokenize, with_tokens
from sparktel.operators.words import is_word, split_words

CASES = [
    ("", "", ""),
    ("server started", "server started", ""),
    ("report for 1999-12-31", "report for <Date>", ""),
    ("report for 31/dec/99", "report for <Date>", ""),
    ("at 23:59:58,125 stopped", "at <Time> stopped", ""),
    ("since 2031-07-08T09:10:11Z", "since <ISO8601>", ""),
    ("key {01234567-89ab-cdef-0123-456789abcdef} deleted", "key <UUID> <HTTPMethod>", ""),
    ("peer 172.16.254.1:8080 lost", "peer <IPv4> lost", ""),
    ("mail to first.last+tag@mail.example.net sent", "mail to <Email> sent", ""),
    ("host db-1.internal.example not found", "host <FQDN> not found", ""),
    ("read /etc/app/config.yaml", "read <Path>", ""),
    ("called /search?q=a&n=2", "called <Path>", ""),
    ("in worker@v2.0.1/pool/run.go:77 failed", "in <ModuleName> failed", ""),
    ("warn: queue full, 17 messages", "<Loglevel> queue full <Number> messages", "warn"),
    ("FATAL error in request", "<Loglevel> error in request", "fatal"),
    ("job zq81-77fx started after 3 sec", "job <Identifier> started after <Duration>", ""),
    ("first\r\nsecond", "first", ""),
    ("\x1b[1;32mready\x1b[0m", "ready", ""),
    ("user 'a \\' b' and \"c\" removed", "user <QuotedString> and <QuotedString> removed", ""),
    ("it said 'nothing", "it said nothing", ""),
]


@pytest.mark.parametrize("text,items,level", CASES)
def test_tokens(text, items, level):
    m = tokenize(text)
    assert (" ".join(m.items), m.level) == (items, level)


def test_limit():
    assert tokenize("hello 12345" + " foo bar" * 10, 5).items == ["hello", "<Number>", "foo", "bar", "foo"]


def test_json_fingerprints():
    # Hashes that the wire format of fingerprints requires.
    assert tokenize('{"msg": "alice bob", "key": "value"}').fingerprint() == -4799080351441142732
    body = '{"msg": "alice %s", "user": {"id": 123, "name": "John Doe"}, "action": "login", "timestamp": "2024-06-16T18:41:32.309Z"}'
    assert tokenize(body % "john").fingerprint() == -1298215320945995457
    assert tokenize(body % "nancy").fingerprint() == -4204312781059083134
    assert fingerprint([], []) == -1205034819632174695


def test_json_parts():
    assert deep_keys({"a": 1, "b": {"c": 2, "d": {"e": 3}}, "z": {}, "l": [{"q": 1}]}) == ["a", "b.c", "b.d.e", "l"]
    assert find_json('x {"a": "}"} y') == ("x ", {"a": "}"}, " y")
    assert find_json("x {nope} y") is None and find_json('{"a": NaN}') is None and find_json('{"a": 1e999}') is None
    assert lookup({"z": {"msg": "in"}, "msg": ""}, ("message", "msg")) == "in"


def test_words():
    assert split_words("thisIs_aTest") == ["this", "is", "a", "test"]
    assert is_word("Hello") and is_word("helloWorld") and not is_word("pid") and not is_word("xyznonexistent") and not is_word("hello world")


def groups(messages, threshold=0.5, most=50):
    c = Clusterer(threshold)
    out = []
    for m in messages:
        t = tokenize(m, most)
        out.append(c.cluster(t.items, t.keys or []))
    return out


def test_clusters():
    a = groups(["error reading file /tmp/a.txt not found", "error reading file /tmp/b/c.txt not found", "database connection to 10.0.0.1 failed after 30s", "database connection to 10.0.0.2 failed after 10s"])
    assert a[0] == a[1] and a[2] == a[3] and a[0] != a[2]
    b = groups(["User logged in from 192.168.1.100", "User logged in from 10.0.0.50"])
    assert b[0] == b[1]
    q = groups(["request for user 12345 completed in 12ms", "request for user 99 completed in 1ms"], most=15)
    assert q[0] == q[1]
    c = Clusterer(0.8)
    assert c.cluster(["foo", "bar", "baz", "qux"], []) != c.cluster(["foo", "bar", "baz", "quux"], [])


def test_clusters_by_tenant(spark):
    rows = [(t, i, m) for t in ("x", "y") for i, m in enumerate(["user logged in", "user logged out", None, "disk full error"])]
    df = with_tokens(spark.createDataFrame(rows, "tenant string, ord int, body string"), "body")
    out = with_clusters(df, "tenant", ["ord"]).toPandas()
    assert len(out) == 8 and (out[out.body.isna()].log_cluster == 0).all()
    x, y = (out[out.tenant == t].sort_values("ord").log_cluster.tolist() for t in "xy")
    assert x == y and x[0] == x[1] != x[3]
    assert with_tokens(spark.createDataFrame([], "body string"), "body").count() == 0


def test_tenants():
    t = Tenants()
    a = t.cluster("x", ["disk", "full"], [])
    assert t.cluster("x", ["disk", "full"], []) == a and sorted([*t.ids(), t.cluster("y", ["up"], []) and "y"]) == ["x", "y"] and len(t) == 2
    assert t.remove("x") and not t.remove("x") and t.ids() == ["y"]


def test_clusters_of_many_tasks(spark):
    """The clusters are those of one clusterer over all rows in order, whatever the partitions; other columns stay with their rows."""
    messages = [f"user {w} logged {d}" for w in ("alpha", "beta", "gamma") for d in ("in", "out")] + ["disk full", "disk almost full", None]
    rows = [(i % 5, i // 5, messages[i * 7 % len(messages)], f"other {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "file int, ord bigint, body string, other string").repartition(6)
    out = with_clusters(with_tokens(df, "body").withColumn("tenant", F.lit("t")), "tenant", ["file", "ord"]).collect()
    clusters, want = Clusterer(), {}
    for file, ord_, body, other in sorted(rows, key=lambda r: r[:2]):
        m = tokenize(body) if body is not None else None
        want[file, ord_] = (0 if m is None else clusters.cluster(m.items, m.keys or []), other)
    assert {(r["file"], r["ord"]): (r["log_cluster"], r["other"]) for r in out} == want and len(out) == len(rows)
