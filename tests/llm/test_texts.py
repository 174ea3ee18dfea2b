"""Operators on whole texts against brute force: pieces, secrets, exact, near and line dedup."""

import hashlib
import random
import re
import struct
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from oracle_check import compare, connect
from paneloom.llm import (
    exact_dedup,
    line_dedup,
    mixing,
    near_dedup,
    piece_merge,
    queries,
    secret_scan,
)
from paneloom.llm.common import components
from paneloom.lookup import lookup_table
from paneloom.session import materialise

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, block string"


def documents(spark, rows):
    """Rows (doc_id, text[, source]) with extra columns that clash with the operators' own."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, 5, "b") for r in rows
    ]
    return lookup_table(spark, full, DOCS)


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# ------------------------------------------------------------------ pieces


@pytest.fixture(scope="module")
def model():
    return piece_merge.load_model(queries.tokenizer_path())


def test_pieces_equal_library(model):
    own = piece_merge.PieceCodec(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(5)
    pieces = list(own.ids)
    texts = ["", " ", "  a  b ", "▁x ▁", "<s> </s>", "line\nline\t\r\n", "\x00", "é漢字😀​"]
    texts += ["ab" * 20_000, "the " * 5_000, "▁" * 99]
    for _ in range(300):
        some = rng.choices(pieces, k=rng.randrange(25))
        texts.append("".join(some).replace("▁", rng.choice([" ", "▁", ""])))
        texts.append("".join(rng.choices("abcdesthein  ▁é漢😀", k=rng.randrange(60))))
    for text in texts:
        packed = own.encode(text)
        ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
        assert ids == library.encode(text, add_bos=True, add_eos=True), text[:50]
        assert own.decode(ids) == library.decode(ids), text[:50]
    for _ in range(2000):
        ids = [rng.randrange(rng.choice([3, 259, 32_000])) for _ in range(rng.randrange(9))]
        assert own.decode(ids) == library.decode(ids), ids


def test_pieces_columns(spark, model):
    docs = documents(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x" * 30_000)])
    rows = docs.select(
        "doc_id", piece_merge.encode("text", model).alias("ids")
    ).withColumn("back", piece_merge.decode("ids", model)).collect()
    assert [len(r["ids"]) // 4 for r in rows[:2]] == [2, 2]
    assert [r["back"] for r in rows] == ["", "", "a b", "a b", "x" * 30_000]
    empty = docs.where("false").select(piece_merge.encode("text", model).alias("ids"))
    assert empty.count() == 0
    both = piece_merge.transcode(docs, "text", model)
    assert both.columns == ["doc_id", "lang", "source", "n_chars", "id", "block", "ids", "decoded"]
    assert [(r["ids"], r["decoded"]) for r in both.collect()] == [(r["ids"], r["back"]) for r in rows]


def test_pieces_query(spark, sf_dir, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = {r["doc_id"]: r for r in queries.pieces(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        own = got.pop(r["doc_id"])
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert not got


# ------------------------------------------------------------------ secrets

BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def base_spans(text):
    found = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            length = len(m[2]) if n == 0 else len(m[0])
            if length >= (12, 18, 16)[n]:
                found.append((m.start(), n, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def test_secrets(spark):
    key, github = "AKIA" + "Q" * 16, "ghp_" + "a1B2" * 10
    rows = [
        (1, None),
        (2, ""),
        (3, f"é password = '{'a' * 12}' {key} {'0f' * 8}"),
        (4, "password=token: abcdefghijklmnop"),
        (5, f"Secret:'short' API_KEY={'x' * 40}{'y' * 40_000}"),
        (6, github, "own"),
        (7, github, "own"),
        *[(10 + i, "see eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghijklmnopqr", f"s{i}") for i in range(4)],
        *[(20 + i, "ghp_" + "z9Y8" * 10, "one") for i in range(11)],
        *[(40 + i // 2, "ghp_" + "k7L6" * 10, "two") for i in range(20)],
        (None, key, None),
        (3, f"é password = '{'a' * 12}' {key} {'0f' * 8}"),
    ]
    got = secret_scan.digest(secret_scan.scan(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        spans = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(s.startswith(k) for s in spans) for k in BASE
        )
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[6]["spans"] == f"code_host:0:{len(github)}" and by_id[6]["n_live"] == 1
    assert by_id[10]["spans"] == ""  # four owners share the token: an example
    assert by_id[20]["spans"] == ""  # one owner, eleven repositories: an example
    assert by_id[40]["n_live"] == 1  # ten repositories, each twice
    assert secret_scan.scan(documents(spark, [])).count() == 0


def test_secrets_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.secrets(spark, sf_dir).collect():
        spans = base_spans(texts.pop(r["doc_id"]))
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r["spans"].split(","))
    assert not texts


# ------------------------------------------------------------------ exact dedup


def test_cuckoo_index():
    rng = random.Random(1)
    index, held = exact_dedup.CuckooIndex(2), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    # equal fingerprints and buckets, different keys
    keys += [keys[0][:10] + bytes([i]) * 22 for i in range(6)]
    for _ in range(20_000):
        key = rng.choice(keys)
        if rng.random() < 0.6:
            assert index.put(key, key[0]) == (key not in held)
            held[key] = key[0]
        else:
            assert index.delete(key) == (held.pop(key, None) is not None)
        assert len(index) == len(held)
    assert dict(index.items()) == held
    assert all((k in index) == (k in held) for k in keys)


def test_exact_dedup(spark):
    rows = [
        (5, "a b\tc"), (2, "abc"), (3, "a b c"), (None, "a  b c"), (9, None), (8, ""), (7, " \n"),
        (4, "é x"), (6, "é x"), (5, "a b\tc"), (11, "z" * 50_000),
    ]
    got = exact_dedup.deduplicate(documents(spark, rows)).collect()
    kept = sorted((r["doc_id"] or -1) for r in got if r["kept"])
    assert kept == [-1, 4, 6, 7, 11]
    sizes = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in got}
    assert sizes[2] == (None, 5) and sizes[9] == (7, 3) and sizes[4] == (4, 1)
    same = exact_dedup.deduplicate(documents(spark, [(1, "x"), (1, "x")])).collect()
    assert [r["kept"] for r in same].count(True) == 1
    assert exact_dedup.deduplicate(documents(spark, [])).count() == 0


def test_index_changes(spark):
    live = lookup_table(spark, [(bytes([i]) * 32,) for i in (1, 2, 3)], "digest binary")
    changes = lookup_table(
        spark,
        [(bytes([1]) * 32, 1, False), (bytes([4]) * 32, 1, True), (bytes([2]) * 32, 1, False),
         (bytes([2]) * 32, 2, True), (bytes([9]) * 32, 1, False), (None, 1, True)],
        "digest binary, seq long, insert boolean",
    )
    got = exact_dedup.apply_changes(live, changes).collect()
    assert sorted(r["digest"][0] for r in got) == [2, 3, 4]


# ------------------------------------------------------------------ near dedup


def weighted(text, documents_df, total):
    hashes, tf = near_dedup.shingles(text)
    frequent = np.array(sorted(h for h, n in documents_df.items() if n >= near_dedup.RARE * total), np.uint64)
    counts = np.array([documents_df[h] for h in frequent.tolist()])
    return hashes, near_dedup.Weights(total, frequent, counts).of(hashes, tf)


def near_fixture():
    rng = random.Random(3)
    rows = []
    for group in range(40):
        base = words(rng, rng.choice([12, 60, 300]))
        for _ in range(rng.choice([1, 2, 6])):
            own = list(base)
            for _ in range(rng.randrange(1 + len(base) // 25)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + i, rows[0][1]) for i in range(5)]  # copies
    rows += [(1000, None), (1001, ""), (1002, "a b"), (1003, "A, b!"), (1004, "... !"), (0, rows[0][1])]
    rows.append((1005, " ".join(words(rng, 30_000, 10**6))))
    return rows


def brute_classes(rows):
    total, df = len(rows), {}
    for _, text in rows:
        for h in near_dedup.shingles(text)[0].tolist():
            df[h] = df.get(h, 0) + 1
    vectors = [weighted(t, df, total) for _, t in rows]
    label = list(range(total))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(total):
        for j in range(i):
            if root(i) == root(j):
                continue
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or near_dedup.similarity(vectors[i], vectors[j]) >= near_dedup.SIMILARITY:
                label[root(i)] = root(j)
    want = {}
    for i, (doc, _) in enumerate(rows):
        want.setdefault(root(i), set()).add(doc)
    return {d: min(group) for group in want.values() for d in group}


def test_near_dedup(spark):
    rows = near_fixture()
    expected = brute_classes(rows)
    got = near_dedup.classes(documents(spark, rows))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == expected
    assert got.count() == len(rows)
    kept = near_dedup.one_of_each(documents(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))
    assert kept.columns == documents(spark, []).columns


def test_near_dedup_large_group(spark):
    """Variants around one text, farther from each other than from it, beside an unrelated text."""
    rng = random.Random(8)
    base = words(rng, 400)
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        own = list(base)
        for _ in range(rng.randrange(1, 10)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows.append((900, " ".join(words(rng, 400))))
    expected = brute_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got[900] == 900 and set(expected.values()) > {0, 900}
    wrong = sum(got[d] != c for d, c in expected.items())
    assert wrong <= 0.01 * len(rows)  # what no band brings together


def test_near_dedup_spread_out_group(spark, monkeypatch):
    """Pairs of variants of one template in long buckets of most of them, none near a common text."""
    monkeypatch.setattr(near_dedup, "LONG_BANDS", 4)
    monkeypatch.setattr(near_dedup, "LONG_ROWS", 1)
    rng = random.Random(12)
    base = words(rng, 600)

    def varied(own, n):
        own = list(own)
        for _ in range(n):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        return own

    rows = []
    for _ in range(120):
        pair = varied(base, 3)
        rows += [(len(rows) + i, " ".join(varied(pair, 5))) for i in range(2)]
    expected = brute_classes(rows)
    linked = [d for d, c in expected.items() if d != c]
    assert len(linked) > 60 and len(set(expected.values())) > 60
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    lost = sum(got[d] != c for d, c in expected.items())
    assert lost <= 0.02 * len(linked), (lost, len(linked))  # what no band brings together


def test_near_dedup_empty(spark):
    assert near_dedup.classes(documents(spark, [])).count() == 0


def test_samples_follow_similarity():
    """The share of equal samples is the weighted Jaccard similarity."""
    rng = np.random.default_rng(0)
    sampler = near_dedup.Sampler(bands=500, rows=4)
    hashes = np.sort(rng.integers(0, 2**63, 60, dtype=np.uint64))
    a, b = (hashes[:45], rng.uniform(0.5, 4, 45)), (hashes[10:], rng.uniform(0.5, 4, 50))
    x, y = sampler.samples(*a), sampler.samples(*b)
    share = float(np.mean((x[0] == y[0]) & (x[1] == y[1])))
    assert abs(share - near_dedup.similarity(a, b)) < 0.04


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (None, 3)]
    got = components(lookup_table(spark, chain, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {
        **{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100
    }


@pytest.fixture
def scattered(spark):
    """A function that runs another with 24 partitions everywhere: its result and the checkpoint files written."""
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in settings}
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))

    def run(what):
        before = set(folder.rglob("part-*"))
        return what(), len(set(folder.rglob("part-*")) - before)

    for k, v in settings.items():
        spark.conf.set(k, v)
    yield run
    for k, v in was.items():
        spark.conf.set(k, v)


def test_components_of_scattered_links_stay_compact(spark, scattered):
    shuffled = [(i * 7919 % 801, (i * 7919 + 7919) % 801) for i in range(800)]  # one chain, ids out of order
    star = [(5000, 5001 + i) for i in range(500)]
    links = lookup_table(spark, shuffled + star, "a long, b long").repartition(24)
    got, written = scattered(lambda: {r["node"]: r["component"] for r in components(links).collect()})
    assert got == {**{i: 0 for i in range(801)}, **{5000 + i: 5000 for i in range(501)}}
    assert written < 24 * 8  # the links once in 24 files, each round in as few as there are cores


def test_near_dedup_keeps_few_small_files(spark, scattered):
    rng = random.Random(3)
    rows = []
    for i in range(0, 30, 3):
        text = " ".join(words(rng, 200))
        rows += [(i, text), (i + 1, text), (i + 2, f"{text} more")]
    docs = documents(spark, rows).repartition(24)
    got, written = scattered(lambda: near_dedup.classes(docs).collect())
    assert {(r["doc_id"], r["class_id"], r["class_size"]) for r in got} == {(i, i - i % 3, 3) for i in range(30)}
    assert written < 24 * 20  # 28 tables of 24 files and more, one for each step, were kept before


# ------------------------------------------------------------------ line dedup


def test_only_lines_with_blank_ends_are_trimmed(spark):
    ends = ["", " ", "\t", "\r", " \t\r ", "\x0b", "\u00a0"]
    raw = [a + middle + b for a in ends for b in ends for middle in ("", "x", "é y\t z")]
    lines = lookup_table(spark, [(x,) for x in raw], "raw string").select(
        "raw", line_dedup._trimmed("raw").alias("line")
    )
    assert all(r["line"] == r["raw"].strip(" \t\r") for r in lines.collect())
    plan = line_dedup._lines(documents(spark, []), "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(" in plan and len(re.findall(r"(?<!THEN )trim\(", plan)) == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng, line, n):
    own = list(line)
    for _ in range(n):
        at = rng.randrange(len(own))
        kind = rng.randrange(3)
        if kind == 0:
            own[at] = rng.choice("abcé😀 ")
        elif kind == 1:
            own.insert(at, rng.choice("abcé😀"))
        else:
            del own[at]
    return "".join(own)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_within_edits(spark, threshold):
    rng = random.Random(threshold)
    pairs = []
    for _ in range(150):
        line = "".join(rng.choices("abcé😀 ", k=rng.randrange(8, 90)))
        pairs.append((line, changed(rng, line, rng.randrange(6))))
    chars = [F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)) for c in ("a", "b")]
    df = lookup_table(spark, pairs, "a string, b string")
    rows = df.select("a", "b", line_dedup.within_edits(*chars, threshold).alias("d")).collect()
    for r in rows:
        want = edits(r["a"], r["b"])
        assert r["d"] == (want if want <= threshold else None), (r["a"], r["b"], want)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_probes_cut_lines_without_a_walk(spark, threshold):
    """Lines within the threshold share a looked-up hash, and cutting them never walks over characters."""
    rng = random.Random(threshold)
    pairs = []
    for _ in range(150):
        line = "".join(rng.choices("abcé😀 ", k=rng.randrange(10, 60)))
        other = changed(rng, line, rng.randrange(threshold + 1))
        pairs.append(sorted((line, other), key=len, reverse=True))
    look = line_dedup.probes(threshold)
    hashes = [h.alias(f"h{n}") for n, (_, h) in enumerate(look)]
    lines = lookup_table(spark, [(x,) for x in {x for p in pairs for x in p}], "line string")
    found = line_dedup.with_cuts(lines.repartition(2), threshold).select("line", *hashes)
    looked = {r["line"]: [*r][1:] for r in found.collect()}
    for longer, shorter in pairs:
        own = {h for h, (is_own, _) in zip(looked[shorter], look) if is_own}
        assert own & set(looked[longer]) and None not in own, (longer, shorter)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(wide" in plan and "substring(line" not in plan


def test_bitmaps_are_read_as_whole_numbers(spark):
    """Each bit of a word is told from the others, and a row's bit is found without text."""
    size = line_dedup._BITS
    inside = [*range(0, 200, 3), 32_767, 32_768, size - 1, -5, 7 * size + 1000]
    ids = lookup_table(spark, [(x,) for x in inside], "id long")
    rows = spark.range(-40, 40_000).select(F.col("id").alias("hash"))
    marked = line_dedup._marked(rows, "hash", materialise(line_dedup._bitmap(ids)))
    got = {r["hash"] for r in marked.where("in_bitmap").collect()}
    assert got == {x for x in range(-40, 40_000) if x % size in {y % size for y in inside}}
    assert "conv(" not in marked._jdf.queryExecution().optimizedPlan().toString()


def test_near_lines(spark):
    rng = random.Random(4)
    lines = []
    for _ in range(30):
        line = "".join(rng.choices("abcdefghé ", k=rng.randrange(48, 70))).strip() + "q"
        lines += [line, *(changed(rng, line, rng.randrange(5)).strip() for _ in range(6))]
    docs = documents(spark, [(i, x) for i, x in enumerate(lines)])
    got = {
        frozenset((bytes(r["a"]), bytes(r["b"])))
        for r in line_dedup.near_lines(docs).collect()
    }
    key = {x: hashlib.md5(x.strip().encode()).digest() for x in lines}
    want = {
        frozenset((key[a], key[b]))
        for a in key
        for b in key
        if a < b and min(len(a.strip()), len(b.strip())) >= 48 and edits(a.strip(), b.strip()) <= 2
    }
    assert got == want and want


def test_near_lines_short(spark):
    """Lines from MIN_CHARS code points on are in the edit join."""
    rng = random.Random(5)
    lines = ["Anheerat, by in ofonthhahe er. Erin.", "Anheerat by in ofonthhahe er. Erin."]
    for size in range(8, 48):
        line = "q" + "".join(rng.choices("abcdefghé ", k=size - 2)) + "q"
        lines += [line, *(changed(rng, line, rng.randrange(4)).strip() for _ in range(3))]
    got = {
        frozenset((bytes(r["a"]), bytes(r["b"])))
        for r in line_dedup.near_lines(documents(spark, list(enumerate(lines)))).collect()
    }
    key = {x: hashlib.md5(x.encode()).digest() for x in lines}
    want = {
        frozenset((key[a], key[b]))
        for a in key
        for b in key
        if a < b and min(len(a), len(b)) >= 10 and abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2
    }
    assert got == want and len(want) > 40


def test_line_dedup(spark):
    long = "The quick brown fox jumps over the lazy dog beside the river bank."
    rows = [
        (2, f"{long}\nunique two\n\n  short\n"),
        (1, f"first\n{long}!\n{long}"),
        (3, "short \nother"),
        (4, None),
        (5, ""),
        (None, "first\nnull id"),
        (6, "last\n" + "z" * 30_000),
        (6, "last\n" + "z" * 30_000),
    ]
    found = line_dedup.deduplicate(documents(spark, rows))
    got = found.select(
        "doc_id", "text", line_dedup.remaining(F.col("text"), F.col("dropped")).alias("left")
    ).collect()
    left = {r["doc_id"]: r["left"] for r in got}
    assert left[1] == f"first\n{long}!"
    assert left[2] == "unique two\n\n  short\n"
    assert left[3] == "other" and left[4] is None and left[5] == ""
    assert left[None] == "null id"
    assert left[6] == "last\n" + "z" * 30_000 and len(got) == len(rows)
    assert line_dedup.deduplicate(documents(spark, [])).count() == 0


def test_line_query(spark, sf_dir):
    """Against brute force over equal lines; near ones are held to their definition."""
    docs = {
        r["doc_id"]: r["text"] or ""
        for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    }
    rows = queries.lines(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    seen, must = set(), {}
    for doc in sorted(docs):
        for n, line in enumerate(docs[doc].split("\n")):
            line = line.strip(" \t\r")
            if line and line in seen:
                must.setdefault(doc, set()).add(n)
            seen.add(line)
    for r in rows:
        dropped = {int(x) for x in r["dropped_lines"].split(",") if x}
        assert must.get(r["doc_id"], set()) <= dropped
        kept = [x for n, x in enumerate(docs[r["doc_id"]].split("\n")) if n not in dropped]
        assert r["text_sha256"] == hashlib.sha256("\n".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    notes = compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL[name])
    assert not notes, "\n".join(notes)


# ------------------------------------------------------------------ names of the caller


OWN = ["own_key", "Own_Turn", "own_id", "own_node", "own_hash", "in_bitmap", "bitmap_bits", "dropped_doc",
       "dropped_hash", "mix_at", "mix_of", "mix_block", "mix_cutoff", "text_in", "text_in_of_caller"]


def test_columns_called_like_the_operators_own_survive(spark, model):
    rng = random.Random(17)
    common = " ".join(words(rng, 40))
    rows = [(i, f"{common}\n{' '.join(words(rng, 30))}", "s") for i in range(6)]
    rows += [(9, rows[0][1], "s"), (10, None, None)]
    docs = documents(spark, rows).withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in OWN})
    docs = docs.withColumns({c: F.lit(-1) for c in ("dropped", "ids", "decoded", "mix_shard", "mix_order")})
    plain = docs.drop(*OWN)

    def rows_of(found, *names):
        assert set(OWN) <= set(found.columns) and len(set(found.columns)) == len(found.columns)
        got = found.select("doc_id", *OWN, *names).collect()
        assert all(r[c] == f"{c} {r['doc_id']}" for r in got for c in OWN)
        return sorted((r["doc_id"], *map(str, r[1 + len(OWN):])) for r in got)

    def same(operator, *names):
        a, b = rows_of(operator(docs), *names), operator(plain).select("doc_id", *names).collect()
        assert a == sorted((r[0], *map(str, r[1:])) for r in b)
        assert all("-1" not in x[1:] for x in a)
        return a

    assert len(same(near_dedup.one_of_each)) == 7
    assert [x[1] for x in same(line_dedup.deduplicate, "dropped") if x[0] == 1] == ["[0]"]
    assert same(lambda d: mixing.mixed(d, shards=3, blocks=8), "mix_shard", "mix_order")
    assert len(same(lambda d: piece_merge.transcode(d, "text", model), "ids", "decoded")) == 8
