from pyspark.sql import functions as F

from winnowry.llm import urls


def test_hosts(spark):
    rows = [("http://A.example.com/x", "a.example.com"), ("https://u:p@h.org:80/?q", "h.org"), ("ftp://h#f", "h"), ("nonsense", None), ("", None),
            (None, None), ("http:///path", None)]
    got = spark.createDataFrame(rows, "url string, want string").select("want", urls.host_of(F.col("url")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)


def test_entries_as_of_a_day(spark):
    changes = [("x.org", 10, True), ("x.org", 20, False), ("x.org", 20, False), ("x.org", 30, True), ("a.x.org", 15, True), ("org", 5, False),
               ("tie.org", 1, True), ("tie.org", 1, False), (None, 1, True), ("n.org", None, True), ("m.org", 1, None)]
    hosts = ["x.org", "a.x.org", "tie.org", "m.org", "n.org", None]
    captures = [(h, d, f"{h}{d}") for h in hosts for d in (0, 9, 10, 15, 19, 20, 29, 30, 99)] + [("x.org", 10, "again"), ("x.org", None, "z")]
    history = {}
    for e, d, on in changes:
        if e and d is not None and on is not None:
            history.setdefault(e, {})[d] = max(on, history.get(e, {}).get(d, False))

    def active(host, day):
        if host is None or day is None:
            return []
        parts = host.split(".")
        out = []
        for e in {".".join(parts[i:]) for i in range(len(parts))}:
            before = [d for d in history.get(e, {}) if d <= day]
            if before and history[e][max(before)]:
                out.append(e)
        return sorted(out)

    got = urls.active_entries(spark.createDataFrame(captures, "host string, day int, active_from string"),
                              spark.createDataFrame(changes, "entry string, day int, listed boolean")).collect()
    assert len(got) == len(captures)
    for r in got:
        want = active(r["host"], r["day"])
        assert (r["n_active"], r["active_entries"]) == (len(want), ",".join(want))


def test_empty(spark):
    captures = spark.createDataFrame([("a.b", 1)], "host string, day int")
    changes = spark.createDataFrame([], "entry string, day int, listed boolean")
    assert urls.active_entries(captures, changes).first()["n_active"] == 0
    assert urls.active_entries(captures.limit(0), changes).count() == 0
