"""Search, toxicity, WARC, URL rules, mixing and the pipeline against brute force."""

import datetime as dt
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paneloom.llm import cover_tree, mixing, queries, toxicity, url_rules, warc
from paneloom.lookup import lookup_table

# ------------------------------------------------------------------ search


def brute_top(rows, asked, k):
    """rows: (position, id, ints)."""
    out = []
    for p, q, x in rows:
        if q is None or not asked(q):
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(x, y)), i is None, i or 0, n)
            for n, i, y in rows
            if n != p and len(y) == len(x)
        )[:k]
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i, _) in enumerate(scores)]
    return sorted(out, key=str)


def test_top_k(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(0, 400)]
    vectors += [(500 + i, vectors[10][1]) for i in range(40)]  # one very common vector
    vectors += [(700, None), (750, [0.1, None, 0.2, 0.1, 0.1, 0.1]), (800, [float("nan")] * 6)]
    vectors += [(850, [float("inf")] * 6), (900, [0.5, 0.25]), (50, vectors[50][1]), (None, [0.9] * 6)]
    vectors += [(950, [])]
    df = lookup_table(spark, [(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<double>, rank int, score int")
    got = cover_tree.top_k(df, F.col("vec_id") % 50 == 0, block_rows=90, query_rows=4).collect()
    rows = [
        (n, i, [int(np.floor(256 * x)) for x in v])
        for n, (i, v) in enumerate(vectors)
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    want = brute_top(rows, lambda q: q % 50 == 0, 5)
    assert sorted([tuple(r) for r in got], key=str) == want
    assert cover_tree.top_k(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_huge_values():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 2.0**40, (60, 3)))
    rows = np.arange(60)
    best = cover_tree.search(x[:7], rows[:7], x, rows, rows, 4)
    for q in range(7):
        scores = [(-sum(int(a) * int(b) for a, b in zip(x[q], x[n])), n) for n in range(60) if n != q]
        assert [(-int(s), int(i)) for s, i in zip(best.scores[q], best.ids[q])] == sorted(scores)[:4]


def test_cover_tree_covers():
    x = np.random.default_rng(4).normal(0, 1, (900, 4))

    def check(node):
        gaps = np.sqrt(np.square(x[node.rows] - node.centre).sum(axis=1))
        assert gaps.max() <= node.radius + 1e-12
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
        for c in node.children:
            check(c)

    check(cover_tree.build(x))


def test_top_k_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(n, i, [int(np.floor(256.0 * x)) for x in v]) for n, (i, v) in enumerate(rows)]
    got = sorted([tuple(r) for r in queries.nearest(spark, sf_dir).collect()], key=str)
    assert got == brute_top(rows, lambda q: q % 50 == 0, 5)


# ------------------------------------------------------------------ toxicity


def test_toxicity_learns_pairs(spark):
    """Two harmless terms are toxic together only: single weights can't tell."""
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(2400):
        text = [f"w{rng.randrange(150)}" for _ in range(12)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text += ["zzinsult"] * insult + ["qqgroup"] * group
        rng.shuffle(text)
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 1, int(insult and group)))
    docs += [(5000, None, "en", "s", 1), (5001, "", "en", "s", 1), (None, "zzinsult qqgroup", None, None, None)]
    docs += [(5002, "zzinsult qqgroup " * 9000, "en", "s", 1)]
    labels += [(None, 0, 1), (3, 0, None), (3, 1, labels[3][2]), (9999, 1, 1)]
    d = lookup_table(spark, docs, "doc_id long, text string, lang string, source string, n_chars long")
    y = lookup_table(spark, labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(d, y).collect()}
    assert len(got) == len(docs)
    truth = {i: t for i, _, t in labels if i is not None and i < 2400 and t is not None}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(held)) for i in truth)
    right = sum(got[i]["predicted"] == truth[i] for i in held)
    assert right >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and not got[None]["held_out"]
    clean = toxicity.keep_clean(d, y)
    assert clean.columns == d.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, r in got.items() if r["score"] < 0.5}
    nothing = toxicity.score_documents(d, y.where("false")).collect()
    assert len(nothing) == len(docs) and all(r["predicted"] == 0 for r in nothing)
    assert toxicity.score_documents(d.where("false"), y).count() == 0


def test_toxicity_query(spark):
    """Held-out rows of a table that none of the settings was fitted to."""
    sf = "/root/testdata/sf0.1"
    truth = {
        r["doc_id"]: r["toxic"]
        for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
    }
    got = {r["doc_id"]: r["score"] for r in queries.toxic(spark, sf).where("held_out").collect()}
    bad = [got[i] for i, t in truth.items() if t == 1 and i in got]
    good = [got[i] for i, t in truth.items() if t == 0 and i in got]
    above = np.mean([b > g for b in bad for g in good])
    assert above >= 0.9, above


# ------------------------------------------------------------------ WARC

FIELDS = "array<struct<name:string,value:string>>"
RECORDS = f"record_id string, type string, url string, date timestamp, status int, headers {FIELDS}, payload_digest string"


def at(second):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


def test_resolve(spark):
    full = [("etag", '"a"'), ("content-length", "9"), ("set-cookie", "x"), ("date", "old")]
    short = [("etag", 'W/"a"'), ("date", "new"), ("content-length", "0"), ("vary", "accept")]
    rows = [
        ("r1", "response", "http://www.x.org/p/?b=2&a=1", at(0), 200, full, "d1"),
        ("r2", "response", "https://x.org:443/p?a=1&b=2&utm_source=z#f", at(9000), 200, [("etag", '"b"')], "d2"),
        ("r3", "response", "http://x.org/p?a=1&b=2", at(9500), 404, full, "d1"),
        ("v1", "revisit", "http://X.org/p?a=1&b=2", at(8000), 304, short, None),
        ("v2", "revisit", "http://x.org/p?a=1&b=2", at(9001), 304, short, None),
        ("v3", "revisit", "http://x.org/p?a=1&b=2", at(9000), 304, [], "d1"),
        ("v4", "revisit", "http://x.org/p?a=1&b=2", at(0), 304, [], None),
        ("v5", "revisit", "http://x.org/p?a=1&b=2", at(9999), 304, [], None),
        ("v6", "revisit", None, at(1), 304, [], None),
        ("v7", "revisit", "http://x.org/p?a=1&b=2", None, 304, [], None),
        ("v8", "revisit", "http://x.org/p?a=1&b=2", at(9999), 304, [("last-modified", "m")], None),
    ]
    # one URL with very many captures, over slices and within one
    rows += [(f"h{i:05}", "response", "http://hot/", at(i * 7), 200, [("etag", f'"{i}"')], None) for i in range(1200)]
    rows += [(f"w{i:05}", "revisit", "http://hot", at(i * 7 + 1), 304, [("etag", f'"{i}"')], None) for i in range(1200)]
    df = lookup_table(spark, rows, RECORDS)
    got = {r["record_id"]: r for r in warc.resolve(df).collect()}
    assert len(got) == 8 + 1200
    assert got["v1"]["response_id"] == "r1" and got["v1"]["outcome"] == "resolved"
    merged = [tuple(h) for h in got["v1"]["headers"]]
    assert merged == [("content-length", "9"), ("date", "new"), ("etag", 'W/"a"'), ("set-cookie", "x"), ("vary", "accept")]
    assert got["v2"]["outcome"] == "mismatch" and got["v2"]["response_id"] is None
    assert (got["v3"]["outcome"], got["v3"]["response_id"]) == ("resolved", "r1")
    assert [got[v]["outcome"] for v in ("v4", "v6", "v7")] == ["no_response"] * 3
    assert (got["v5"]["outcome"], got["v5"]["response_id"]) == ("unchecked", "r2")
    assert got["v8"]["outcome"] == "mismatch"
    assert all(got[f"w{i:05}"]["response_id"] == f"h{i:05}" for i in range(1200))
    assert warc.resolve(df.where("false")).count() == 0


def test_warc_files(spark, tmp_path):
    import gzip

    pages = lookup_table(
        spark,
        [(1, "http://a.org/x", "<p>\r\n\r\nbody\u00e9</p>"), (2, "http://a.org/y", None), (3, None, ""), (4, "nothing", "z" * 30_000)],
        "page_id long, url string, html string",
    )
    texts = [r["record"] for r in queries._captures(pages).where("record is not null").collect()]
    assert len(texts) == 8
    for name, packed in (("plain", "\r\n\r\n".join(texts).encode()), ("packed", b"".join(gzip.compress(t.encode()) for t in texts))):
        path = tmp_path / (f"{name}.warc" + (".gz" if name == "packed" else ""))
        path.write_bytes(packed)
        got = {r["record_id"]: r for r in warc.parse(warc.read(spark, str(path))).collect()}
        assert got["r1"]["body"] == "<p>\r\n\r\nbody\u00e9</p>" and got["r1"]["status"] == 200
        assert got["v1"]["type"] == "revisit" and got["v1"]["url"] == "http://a.org/x?utm_source=again"
        assert got["r4"]["body"] == "z" * 30_000 and got["r1"]["date"] == dt.datetime(2024, 1, 1, 0, 0, 1)
    odd = warc.parse(lookup_table(spark, [(None,), ("",), ("x\r\n\r\n",)], "record string")).collect()
    assert [r["type"] for r in odd] == [None] * 3


def test_warc_lengths(spark, tmp_path):
    """Versions inside URLs and payloads, both versions, no length, cut ends, several splits."""

    def record(name, payload, version="1.0", length=True, url="http://a.org/"):
        size = f"Content-Length: {len(payload.encode())}\r\n" if length else ""
        return f"WARC/{version}\r\nWARC-Type: resource\r\nWARC-Record-ID: {name}\r\nWARC-Target-URI: {url}\r\n{size}\r\n{payload}"

    rng, first, second = random.Random(8), {}, {}
    for i in range(300):
        payload = "".join(rng.choice(["WARC/1.", "WARC/1.0\r\n", "WARC/1.1\r\nContent-Length: 9\r\n\r\n", "\u00e9", "\r\n\r\n"]) for _ in range(rng.randrange(40)))
        name = f"a{i}"
        first[name] = record(name, payload, rng.choice(["1.0", "1.1"]), url=rng.choice(["http://a.org/", "http://a.org/WARC/1.0"]))
    second = {"b1": record("b1", "no length", length=False), "b2": record("b2", "kept \u00e9")}
    (tmp_path / "one.warc").write_bytes("\r\n\r\n".join(first.values()).encode())
    (tmp_path / "two.warc").write_bytes(("junk" + "".join(second.values()) + "\r\n\r\n" + record("b3", "x" * 50)[:-20]).encode())
    (tmp_path / "none.warc").write_bytes(b"")
    expected = sorted([*first.values(), *second.values(), record("b3", "x" * 50)[:-20]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (before, "1000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            got = sorted(r["record"] for r in warc.read(spark, str(tmp_path)).collect())
            assert got == expected
            heads = [r["record"] for r in warc.read(spark, str(tmp_path), payloads=False).collect()]
            assert sorted(heads) == sorted("".join(re.split("(\r\n\r\n)", x)[:4]) for x in expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_revisits_of_odd_pages(spark, tmp_path):
    """Rows without id, URL or text, empty and repeated ones, against the statement."""
    import duckdb

    texts = [None, "", "a", "bb", "ccc", "dddd WARC/1.0\r\n", "\u00e9" * 3]
    rows = [(i, f"http://x.org/{i % 5}", texts[i % 7], "mine") for i in range(60)]
    rows += [(None, "http://x.org/1", "a", None), (None, None, None, None), (70, None, "a", None), (71, "plain", "bb", None)]
    odd = lookup_table(spark, [*rows, rows[3]], "page_id long, url string, html string, record string")
    odd.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((str(tuple(r)) for r in queries.revisits(spark, str(tmp_path)).collect()))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names = "page_id, canonical_url, outcome, response_page_id, response_at, headers"
    expected = duck.execute(f"SELECT {names} FROM ({queries.REVISITS_SQL})").fetchall()
    assert got == sorted(map(str, expected)) and len(got) == 65
    assert {r[2] for r in expected} == {"resolved", "unchecked", "mismatch", "no_response"}
    odd.where("false").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert queries.revisits(spark, f"{tmp_path}/none").count() == 0


# ------------------------------------------------------------------ URLs


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return host, path[:stop]


def plain_rule(host, path):
    best = None
    for action, name, start in url_rules.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            if best is None or len(name + start) > len(best[0]):
                best = name + start, action
    return best or (None, None)


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "http://x.net", "http://x.net/", "HTTPS://A.Example.NET/en/1?q#f",
        "http://example.net/en/", "http://badexample.net/en/", "http://b.example.com/de/9", "http://example.com/De/",
        "http://a.org/fr/", "http://org/fr/x", "http://forg/fr/x", "a://b://c.net/x", "http://x.net?y/", "http://x.net#/",
        "http://\u0130.net/\n/en/", "http://h.net/" + "a" * 20_000,
    ]
    df = lookup_table(spark, [(i, u, "h", "r") for i, u in enumerate(urls)] + [(1, "", "h", "r")], "page_id long, url string, host string, rule string")
    nothing = url_rules.mine(df, lookup_table(spark, [], "doc_id long, quality int"))
    got = url_rules.judge(df, nothing).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path = plain_parts(urls[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == (rule, verdict or "allow")
    assert url_rules.judge(df.where("false"), nothing).count() == 0


def test_mined_rules(spark):
    """Pills shops are bad on http alone; the rule names the pair, and brute force agrees."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        scheme, shop = rng.choice(["http", "https"]), rng.choice(["pills", "books", "cars"])
        rows.append((i, f"{scheme}://{shop}.example.io/{rng.choice(['en', 'de'])}/{i}"))
        bad = scheme == "http" and shop == "pills"
        if i % 3:
            labels.append((i, 0 if bad != (rng.random() < 0.05) else 1))
    labels += [(None, 0), (4, None)]
    urls = lookup_table(spark, rows, "page_id long, url string")
    known = lookup_table(spark, labels, "doc_id long, quality int")
    mined = url_rules.mine(urls, known)
    found = [set(r["tokens"]) for r in mined.collect()]
    assert {"scheme:http", "host:pills"} in found
    got = {r["page_id"]: r for r in url_rules.judge(urls, mined).collect()}
    tokens = {
        r["page_id"]: set(r["t"])
        for r in urls.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()
    }
    for i, own in tokens.items():
        assert got[i]["verdict"] == ("block" if any(f <= own for f in found) else "allow")


def test_mined_rules_against_brute_force(spark):
    """Rules of all lengths over a template of many fixed parts, without the tokens that add nothing."""
    import itertools
    import math

    rng, rows, labels = random.Random(4), [], []
    template = "/".join(f"part{c}" for c in "abcdefghijklmnopqrstuvwxyzabcdefghijklmn")
    for i in range(900):
        a, b, c, d = (rng.choice([0, 1]) for _ in range(4))
        place = template if rng.random() < 0.2 else "plain"
        rows.append((i, f"http://{'abc'[i % 3]}.org/{place}?" + "&".join(f"{k}=1" for k, on in zip("wxyz", (a, b, c, d)) if on)))
        bad = (a and b and c and d and rng.random() < 0.9) or (place == template and rng.random() < 0.5) or rng.random() < 0.03
        labels.append((i, 0 if bad else 1))
    urls = lookup_table(spark, rows, "page_id long, url string")
    mined = url_rules.mine(urls, lookup_table(spark, labels, "doc_id long, quality int")).collect()
    own = {r["page_id"]: frozenset(r["t"]) for r in urls.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    bad = {i for i, q in labels if q == 0}
    least, base = max(url_rules.MIN_ROWS, math.ceil(url_rules.MIN_SUPPORT * len(own))), len(bad) / len(own)
    classes = {}
    for t in set().union(*own.values()):
        classes.setdefault(frozenset(i for i, x in own.items() if t in x), []).append(t)
    found = {}
    for k in range(1, len(classes) + 1):
        for some in itertools.combinations([c for c in classes if len(c) >= least], k):
            both = frozenset.intersection(*some)
            hit = len(both & bad)
            if hit < least:
                continue
            p, n, z = hit / len(both), len(both), url_rules.Z
            low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            if low >= url_rules.MIN_LIFT * base:
                found[frozenset(t for c in some for t in classes[c])] = p
    expected = {r for r, p in found.items() if not any(o < r and q >= p for o, q in found.items())}
    assert {frozenset(r["tokens"]) for r in mined} == expected
    assert max(map(len, expected)) > 24 and frozenset(f"key:{k}" for k in "wxyz") in expected
    assert all(r["token"] in r["tokens"] for r in mined)


def test_mined_rule_decides_in_the_query(spark, tmp_path):
    rows = [(i, f"http://{'bad' if i % 5 == 0 else 'good'}.io/{i}", "h", None) for i in range(200)]
    rows += [(500, "http://bad.io/new", "h", None), (501, "http://good.io/new", "h", None), (502, "http://bad.example.net/en/", "h", None)]
    lookup_table(spark, rows, "page_id long, url string, html string, lang string").write.parquet(f"{tmp_path}/pages.parquet")
    lookup_table(spark, [(i, 0 if i % 5 == 0 else 3) for i in range(200)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["page_id"]: r for r in queries.url_verdicts(spark, str(tmp_path)).collect()}
    assert got[500]["verdict"] == "block" and got[500]["rule"] is None and got[500]["mined_tokens"] == "host:bad"
    assert got[501]["verdict"] == "allow" and got[502]["verdict"] == "allow"


def test_url_query(spark, sf_dir):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.url_verdicts(spark, sf_dir).collect():
        host, path = plain_parts(pages.pop(r["page_id"]))
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["mined_tokens"] else "allow"))
    assert not pages


# ------------------------------------------------------------------ mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: most * sizes[s] for s in over})
        free -= over
    return target


def check_mix(rows, tolerance):
    """rows: doc_id, size, source, source_size, target, taken."""
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    target = plain_targets(sizes)
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert all(abs(r["target"] - target[s]) < 1e-6 * max(1, target[s]) for r in own)
        assert abs(sum(r["taken"] for r in own) - target[s]) <= max(r["size"] for r in own) * tolerance + 1e-6
    assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_mix(spark):
    rng = random.Random(9)
    docs = []
    for i in range(3000):
        source = rng.choices(["a", "b", "c", "\u00e9", None, "empty"], [9, 3, 3, 2, 1, 1])[0]
        text = None if source == "empty" else " ".join(["w"] * rng.randrange(60))
        docs.append((i, text, source, 1, 2))
    docs += [(9000, "x " * 20_000, "a", 1, 2), (None, "p q r", "b", 1, 2), (5, docs[5][1], docs[5][2], 1, 2)]
    df = lookup_table(spark, docs, "doc_id long, text string, source string, block int, size int")
    sized, plan, draws = mixing.mix(df, shards=6, blocks=32)
    rows = mixing.taken(sized, plan).collect()
    assert len(rows) == len(docs)
    check_mix(rows, 1)
    again = mixing.taken(*mixing.mix(df.repartition(5), shards=6, blocks=32)[:2]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    # every drawn block is in one shard, and the shards share the units evenly
    units = {}
    for r in plan.collect():
        units[r["source"], r["block"]] = r["copies"] + (r["cutoff"] is not None)
    drawn = {}
    shards = {}
    for r in draws.collect():
        drawn[r["source"], r["block"]] = drawn.get((r["source"], r["block"]), 0) + 1
        shards[r["shard"]] = shards.get(r["shard"], 0) + 1
    assert drawn == {k: n for k, n in units.items() if n}
    assert max(shards.values()) - min(shards.values()) <= 3
    out = mixing.mixed(df, shards=6, blocks=32)
    assert out.columns == [*df.columns, "mix_shard", "mix_order"]
    counts = {}
    for r in out.select("doc_id").collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    want = {}
    for r in rows:
        want[r["id"]] = want.get(r["id"], 0) + r["copies"]
    assert counts == {k: n for k, n in want.items() if n}
    assert mixing.taken(*mixing.mix(df.where("false"))[:2]).count() == 0


def test_mix_query(spark):
    check_mix(queries.mixture(spark, "/root/testdata/sf0.1").collect(), 1)


def test_mix_query_counts_draws(spark, sf_dir, monkeypatch):
    """What no shard draws isn't taken; whole draws agree with the plan and with the mixed rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.mixture(spark, sf_dir).collect()
    planned = mixing.taken(*mixing.mix(docs)[:2]).collect()
    assert sorted((r["doc_id"], r["copies"], r["taken"]) for r in rows) == sorted(
        (r["id"], r["copies"], r["taken"]) for r in planned
    )
    assert sum(r["copies"] for r in rows) == mixing.mixed(docs).count()
    quotas = mixing.shard_quotas
    monkeypatch.setattr(mixing, "shard_quotas", lambda *a: quotas(*a).where("shard <> 0"))
    less = queries.mixture(spark, sf_dir).collect()
    assert len(less) == len(rows)
    assert 0 < sum(r["copies"] for r in less) < sum(r["copies"] for r in rows)


# ------------------------------------------------------------------ pipeline


def test_pipeline(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "pieces"]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], sf_dir).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    for out in seen[:-1]:
        assert out.columns == docs.columns
    clean, lines, near, mix, coded = seen[1:]
    scores = {r["doc_id"]: r["score"] for r in queries.toxic(spark, sf_dir).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in scores.items() if s < 0.5}
    assert lines.count() == clean.count()
    assert not [
        r for r in lines.collect() if r["n_chars"] != len(r["text"])
    ]
    kept = near.collect()
    assert len({r["text"] for r in kept}) == len(kept)
    assert {r["doc_id"] for r in kept} <= {r["doc_id"] for r in lines.collect()}
    assert {r["doc_id"] for r in mix.collect()} <= {r["doc_id"] for r in kept}
    ids = sorted(r["doc_id"] for r in coded.collect())
    assert ids == sorted(r["doc_id"] for r in mix.collect())
    assert coded.where("not round_trip").count() == 0
    again = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, again.collect())) == sorted(map(str, coded.collect()))
